"""Language identification by a byte convolutional network.

Bytes are embedded, convolved by filters of several widths, max-pooled over a
fixed-length window and put through a softmax. The network is trained in numpy
on a bounded, hash-picked sample of labelled texts and applied to all windows
of every text, a batch of windows at a time; a text's score is the mean of its
windows' log probabilities, weighted by their letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.common import bounded, held_out, table

WINDOW = 128
WIDTHS = (2, 4, 6)
STRIDE = 2
FILTERS = 16
EMBEDDING = 8
ROWS_PER_LANGUAGE = 1_500
SAMPLE_CHARS = 256
STEPS = 900
RATE = 0.004
BATCH = 128
UNKNOWN = "und"


def start(languages: list[str], seed: int = 3) -> dict:
    rng = np.random.default_rng(seed)
    model = {"languages": languages, "embed": rng.normal(0, 0.5, (257, EMBEDDING)).astype(np.float32)}
    for w in WIDTHS:
        model[f"w{w}"] = rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)).astype(np.float32)
        model[f"b{w}"] = np.zeros(FILTERS, np.float32)
    model["out"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
    model["bias"] = np.zeros(len(languages), np.float32)
    return model


def filtered(model: dict, embedded: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """What the filters of each width give at every ``STRIDE``-th byte of embedded windows."""
    flat = embedded.reshape(len(embedded), -1)
    for w in WIDTHS:
        views = np.lib.stride_tricks.sliding_window_view(flat, w * EMBEDDING, axis=1)[:, :: STRIDE * EMBEDDING]
        yield w, views @ model[f"w{w}"] + model[f"b{w}"]


def pool(model: dict, x: np.ndarray) -> np.ndarray:
    """Max-pooled filters of windows ``x``, rows of byte codes with 256 as padding."""
    return np.maximum(np.concatenate([out.max(1) for _, out in filtered(model, model["embed"][x])], 1), 0)


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def gradients(model: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    embedded = model["embed"][x]
    outs = dict(filtered(model, embedded))
    best = {w: out.argmax(1) for w, out in outs.items()}
    pooled = np.maximum(np.concatenate([out.max(1) for out in outs.values()], 1), 0)
    logp = log_softmax(pooled @ model["out"] + model["bias"])
    loss = float(-logp[np.arange(len(y)), y].mean())
    dz = np.exp(logp)
    dz[np.arange(len(y)), y] -= 1
    dz /= len(y)
    grads = {"out": pooled.T @ dz, "bias": dz.sum(0), "embed": np.zeros_like(model["embed"])}
    dp = (dz @ model["out"].T) * (pooled > 0)
    rows = np.arange(len(x))[:, None, None]
    for k, w in enumerate(WIDTHS):
        d = dp[:, k * FILTERS : (k + 1) * FILTERS]
        places = best[w][:, :, None] * STRIDE + np.arange(w)  # (row, filter, offset)
        seen = embedded[rows, places].reshape(len(x), FILTERS, -1)
        grads[f"w{w}"] = np.einsum("nf,nfe->ef", d, seen)
        grads[f"b{w}"] = d.sum(0)
        back = (d[:, :, None] * model[f"w{w}"].T[None]).reshape(len(x), FILTERS, w, EMBEDDING)
        np.add.at(grads["embed"], x[rows, places].ravel(), back.reshape(-1, EMBEDDING))
    return loss, grads


def train(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = STEPS, seed: int = 3) -> dict:
    """Adam over at least ``steps`` shuffled batches; the same sample gives the same network."""
    model, rng = start(languages, seed), np.random.default_rng(seed)
    names = [k for k in model if k != "languages"]
    first, second, t = {k: np.zeros_like(model[k]) for k in names}, {k: np.zeros_like(model[k]) for k in names}, 0
    while t < steps:
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            pick = order[at : at + BATCH]
            _, grads = gradients(model, x[pick], y[pick])
            t += 1
            for k in names:
                first[k] = 0.9 * first[k] + 0.1 * grads[k]
                second[k] = 0.999 * second[k] + 0.001 * grads[k] ** 2
                model[k] = (model[k] - RATE * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return model


def windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts as padded rows of ``WINDOW`` codes, and each row's text."""
    data = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(data.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    rows = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(sizes)), rows)
    out = np.full((int(rows.sum()), WINDOW), 256, np.int16)
    first = (np.cumsum(rows) - rows) * WINDOW
    place = np.arange(len(raw)) + np.repeat(first - (offsets[:-1] - offsets[0]), sizes)
    out.reshape(-1)[place] = raw
    return out, doc


def log_probabilities(model: dict, x: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(model["languages"])), np.float32)
    for at in range(0, len(x), 256):
        out[at : at + 256] = log_softmax(pool(model, x[at : at + 256]) @ model["out"] + model["bias"])
    return out


IS_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 128 and b < 256 for b in range(257)])


def predict(model: dict, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and its probability for every text."""
    x, doc = windows(texts)
    weight = IS_LETTER[x].sum(1) + 1e-6
    logp = log_probabilities(model, x) * weight[:, None]
    sums = np.column_stack([np.bincount(doc, weights=logp[:, k], minlength=len(texts)) for k in range(logp.shape[1])])
    mean = sums / np.maximum(np.bincount(doc, weights=weight, minlength=len(texts)), 1e-6)[:, None]
    p = np.exp(log_softmax(mean))
    best = p.argmax(1)
    known = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    return [model["languages"][k] if ok else UNKNOWN for k, ok in zip(best, known)], np.where(known, p[np.arange(len(p)), best], 0.0)


def train_sample(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, chars: int = SAMPLE_CHARS) -> list:
    """About ``rows_per_language`` labelled texts of each language outside the held-out fold.

    Rows are picked by a hash of their id; of each, ``chars`` characters from a
    hashed place in the text are learned from.
    """
    known = docs.select("doc_id", "text", "lang").where("lang is not null and doc_id is not null").where(~held_out(4, 2)).where(F.col("text").rlike(r"\p{L}"))
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return []
    share = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, min(1.0, rows_per_language / n))])
    unit = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    place = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.greatest(F.length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    rows = known.where(unit < share[F.col("lang")]).select("lang", F.substring("text", place, F.lit(chars)).alias("t")).collect()
    return sorted((r.lang, r.t) for r in rows)


def trained(docs: DataFrame) -> dict:
    """A network for all languages that the labels name; None if they name none."""
    rows = train_sample(docs)
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    x, doc = windows(pa.array([t for _, t in rows]))
    y = np.array([languages.index(lang) for lang, _ in rows])[doc]
    return train(x, y, languages)


def identify(docs: DataFrame, model: dict | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``lang_pred`` and ``score`` for every row; ``und`` and 0 where a text has no letter or nothing was learned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, most=1 << 20):
            if model is None:
                names, p = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                names, p = predict(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(p, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from labelled ones outside the held-out fold."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return identify(docs, trained(docs)).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
