"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded words.

Folding lower-cases, strips accents, maps look-alike letters of other scripts to
Latin ones and digits or signs inside a word to the letters they stand for. The
lexicon starts from common insults in four languages, whose weight the labels
move, and learns more from the labels: words, and word beginnings shared by
several words, so much likelier in toxic texts that among all words of the sample
``CHANCE`` of one is expected to look so by accident. Exception phrases, a
match with the word before or behind it, are learned in the same way from texts
that are not toxic. The total weight of a text's matches and that total for each
word of the text enter a small logistic model.

Matching runs over the distinct words of a slice of texts. Only texts with a
match are read again as a whole, to take back matches inside exception phrases.

Null and empty texts have no match; texts of any length are read whole. Rows that
repeat are scored each by itself. Where two entries start at one place the heavier
one counts. Without labels of both classes the score is constant; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.llm.common import Words, bounded, drop_stored, held_out, stored, table

TOXIC_ROWS = 10_000
OTHER_ROWS = 20_000
LEAST_ODDS = 2.0
CHANCE = 0.05
BASE_ODDS = 3.5
BASE_SUPPORT = 4
STEMS = range(4, 9)
# Look-alike letters, digits and signs that stand for letters, common insults.
LOOK_ALIKES = str.maketrans("аеорсухіјѕԁɡһκνοραετυι", "aeopcyxijsdghkvopaetui")
SUBSTITUTES = str.maketrans("0134578@$!", "oieastbasi")
INSULTS = (
    "idiot moron imbecile cretin stupid dumb dumbass loser pathetic worthless scum scumbag trash clown disgusting vermin filth filthy lowlife bastard bitch "
    "asshole jackass jerk retard retarded dimwit halfwit nitwit douchebag shit bullshit fuck fucking fucker slut whore cunt prick wanker twat subhuman "
    "arschloch trottel depp dummkopf scheisse abschaum versager hurensohn schlampe wichser vollidiot "
    "connard connasse salope merde abruti cretin encule imbecile "
    "idiota imbecil estupido estupida pendejo cabron mierda escoria gilipollas"
).split()
INNER_SIGN = re.compile(r"[@$!](?=\w)")
NOT_LETTERS = re.compile(r"[\W_]+")


def fold(word: str) -> str:
    """A word in plain letters; signs at its end are punctuation and go."""
    word = word.lower()
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKD", word).translate(LOOK_ALIKES) if not unicodedata.combining(c))
    if word.isalpha():
        return word
    word = INNER_SIGN.sub(lambda m: m[0].translate(SUBSTITUTES), word)
    if any(c.isalpha() for c in word):
        word = word.translate(SUBSTITUTES) if any(c.isdigit() for c in word) else word
    return NOT_LETTERS.sub(" ", word).strip()


def fold_text(text: str) -> str:
    return " " + " ".join(x for x in map(fold, text.split()) if x) + " "


class Matcher:
    """Aho-Corasick over the lexicon. Entries: `` word `` is a whole word, `` stem`` a beginning."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple | list = ()):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.items():
            self.automaton.add_word(entry, (weight, len(entry)))
        for phrase in exceptions:
            self.automaton.add_word(f" {phrase} ", (None, len(phrase) + 2))
        self.empty = not lexicon
        if not self.empty:
            self.automaton.make_automaton()

    def places(self, folded: str) -> list[int]:
        """Where the words that match start."""
        return [] if self.empty else sorted({end - length + 1 for end, (weight, length) in self.automaton.iter(folded) if weight is not None})

    def weight(self, folded: str) -> float:
        """The summed weight of the words that match, each by its heaviest entry, outside exceptions."""
        if self.empty:
            return 0.0
        spans, best = [], {}
        for end, (weight, length) in self.automaton.iter(folded):
            start = end - length + 1
            if weight is None:
                spans.append((start, end))
            else:
                best[start] = max(weight, best.get(start, 0.0))
        return sum(w for at, w in best.items() if not any(a <= at < b for a, b in spans))


def features(texts: pa.Array, matcher: Matcher) -> np.ndarray:
    """Per text: total weight of its matches, and the same for each hundred words."""
    words = Words(texts, lower=True)
    hit = np.fromiter((matcher.weight(f" {fold(w)} ") > 0 for w in words.vocabulary.to_pylist()), bool, len(words.vocabulary))
    total = np.zeros(len(texts))
    for d in np.unique(words.doc[hit[words.ids]]):
        total[d] = matcher.weight(fold_text(texts[int(d)].as_py()))
    return np.column_stack([np.log1p(total), np.log1p(100 * total / np.maximum(words.counts, 1))])


def train_sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, other_rows: int = OTHER_ROWS) -> DataFrame:
    """At most about ``toxic_rows`` and ``other_rows`` labelled texts outside the held-out fold.

    Rows are taken by a hash of their id, the same on every run. A document with
    several labels counts as toxic if one of them does.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(5, 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, (toxic_rows if k else other_rows) / n))]) if sizes else F.lit(None)
    unit = F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    picked = known.where(unit < share[F.col("toxic")]) if sizes else known
    return stored(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), "toxic-sample")


def lexicon(sample: DataFrame) -> dict[str, float]:
    """Words and word beginnings with their log odds, from ``sample(text, toxic)``.

    Both are counted once for each different word of a text, so that a beginning
    counts by the words it shows up in and a repeated line counts once.
    """

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            words = Words(batch.column("text"), lower=True)
            folded = pa.array([fold(w) for w in words.vocabulary.to_pylist()], pa.string()).dictionary_encode()
            size = max(1, len(folded.dictionary))
            pairs = np.unique(words.doc * size + folded.indices.to_numpy()[words.ids])
            doc, word = np.divmod(pairs, size)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)[doc] > 0
            names, keys = [f" {w} " for w in folded.dictionary.to_pylist()], [word]
            whole = np.arange(size)
            out = [(names, np.bincount(word[toxic], minlength=size), np.bincount(word[~toxic], minlength=size))]
            for n in STEMS:
                cut = pa.array([f" {w[:n]}" if len(w) > n and w.isalpha() else "" for w in folded.dictionary.to_pylist()], pa.string()).dictionary_encode()
                stem = cut.indices.to_numpy()[word]
                out.append((cut.dictionary.to_pylist(), np.bincount(stem[toxic], minlength=len(cut.dictionary)), np.bincount(stem[~toxic], minlength=len(cut.dictionary))))
            for names, yes, no in out:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(yes.astype(np.int64)), pa.array(no.astype(np.int64))], names=["gram", "yes", "no"])

    if 0 in classes(sample):
        return {}
    counts = stored(sample.select("text", "toxic").mapInArrow(grams, "gram string, yes long, no long").where("length(trim(gram)) >= 3").groupBy("gram").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")), "grams")
    yes, no = counts.where("gram like '% '").agg(F.coalesce(F.sum("yes"), F.lit(0)), F.coalesce(F.sum("no"), F.lit(0))).first()
    if not yes or not no:
        yes, no = max(yes, 1), max(no, 1)
    odds = F.log((F.col("yes") + 0.5) / (yes + 1.0)) - F.log((F.col("no") + 0.5) / (no + 1.0))
    certain = surprise(F.col("yes"), F.col("no"), yes / (yes + no)) >= math.log(max(1, counts.count()) / CHANCE)
    base = {f" {w} " for w in map(fold, INSULTS)}
    rows = counts.withColumn("odds", odds).withColumn("learned", certain & (odds >= LEAST_ODDS)).where(F.col("learned") | F.col("gram").isin(sorted(base))).collect()
    drop_stored(counts)
    weight = {r.gram: float(r.odds) for r in rows if r.learned}
    seen = {r.gram: r.yes for r in rows}
    chosen: dict[str, float] = {}
    words = [g for g in weight if g.endswith(" ")]
    for stem in sorted((g for g in weight if not g.endswith(" ")), key=lambda g: (len(g), g)):
        if any(stem[:n] in chosen for n in range(2, len(stem))):
            continue
        # A beginning that is in truth one word is left to that word.
        best = max((seen[w] for w in words if w.startswith(stem)), default=0)
        if best <= seen[stem] / 2:
            chosen[stem] = weight[stem]
    chosen.update({w: weight[w] for w in words if not any(w[:n] in chosen for n in range(2, len(w)))})
    # A known insult starts at its own weight, which as many documents as it has seen move.
    found = {r.gram: (float(r.odds), r.yes + r.no) for r in rows}
    for word in base:
        value, support = found.get(word, (0.0, 0))
        value = (value * support + BASE_ODDS * BASE_SUPPORT) / (support + BASE_SUPPORT)
        if value >= LEAST_ODDS:
            chosen[word] = value
    return chosen


def classes(sample: DataFrame) -> tuple[int, int]:
    """Toxic and other rows of ``sample(toxic)``."""
    yes, total = sample.agg(F.coalesce(F.sum((F.col("toxic") > 0).cast("int")), F.lit(0)), F.count("*")).first()
    return yes, total - yes


def surprise(yes: Column, no: Column, share: float) -> Column:
    """How far ``yes`` of ``yes + no`` documents lie above ``share``, as a bound of minus the log of its chance."""
    q = yes / (yes + no)
    gain = F.when(yes > 0, yes * F.log(q / share)).otherwise(0.0) + F.when(no > 0, no * F.log((1 - q) / (1 - share))).otherwise(0.0)
    return F.when(q > share, gain).otherwise(0.0)


def exceptions(sample: DataFrame, entries: dict[str, float]) -> list[str]:
    """Matches with the word beside them that are far commoner in texts that are not toxic than matches are."""

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(entries)
        for batch in bounded(batches):
            tally: dict[str, list] = {}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                folded = fold_text(text or "")
                places, found = matcher.places(folded), set()
                for at in places:
                    end = folded.index(" ", at + 1)
                    word, behind = folded[at + 1 : end], folded[end + 1 : max(end + 1, folded.find(" ", end + 1))]
                    before = folded[folded.rfind(" ", 0, at) + 1 : at] if at else ""
                    found |= {f"{before} {word}"} if before else set()
                    found |= {f"{word} {behind}"} if behind else set()
                found |= {""} if places else set()
                for phrase in found:
                    tally.setdefault(phrase, [0, 0])[0 if toxic else 1] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(tally), pa.string()), *(pa.array([v[k] for v in tally.values()], pa.int64()) for k in (0, 1))], names=["phrase", "yes", "no"])

    counts = stored(sample.select("text", "toxic").mapInArrow(phrases, "phrase string, yes long, no long").groupBy("phrase").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")), "phrases")
    # The empty phrase counts the texts with any match.
    all_ = counts.where("phrase = ''").first()
    out: list[str] = []
    if all_ and all_.yes and all_.no:
        least = math.log(counts.count() / CHANCE)
        out = [r.phrase for r in counts.where("phrase <> ''").where(surprise(F.col("no"), F.col("yes"), all_.no / (all_.yes + all_.no)) >= least).orderBy("phrase").collect()]
    drop_stored(counts)
    return out


def fit(sample: DataFrame) -> dict:
    """Lexicon and logistic weights from ``sample(text, toxic)``; without both classes a constant."""
    entries = lexicon(sample)
    spared = exceptions(sample, entries) if entries else []

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(entries, spared)
        for batch in bounded(batches):
            x = features(batch.column("text"), matcher)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), batch.column("toxic").cast(pa.int32())], names=["a", "b", "y"])

    rows = sample.select("text", "toxic").mapInArrow(measure, "a double, b double, y int").toPandas()
    x = np.column_stack([np.ones(len(rows)), rows["a"], rows["b"]]) if len(rows) else np.zeros((0, 3))
    y = (rows["y"].to_numpy() > 0).astype(float) if len(rows) else np.zeros(0)
    beta = np.array([math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 0.0, 0.0])
    if entries:
        # Newton steps with a small ridge, halved until the loss falls, so that separable data end too.
        loss = lambda b: np.logaddexp(0, x @ b).sum() - y @ (x @ b) + 0.025 * b @ b
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3), x.T @ (y - p) - 0.05 * beta)
            while loss(beta + step) > loss(beta) and np.abs(step).max() > 1e-9:
                step = step / 2
            beta = beta + step
            if np.abs(step).max() < 1e-8:
                break
    return {"lexicon": entries, "exceptions": spared, "beta": beta.tolist()}


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` for every row; null and empty texts have no match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, beta = Matcher(model["lexicon"], model["exceptions"]), np.array(model["beta"])
        for batch in bounded(batches):
            x = features(batch.column("text"), matcher)
            p = 1 / (1 + np.exp(-np.clip(beta[0] + x @ beta[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text").mapInArrow(run, "doc_id long, score double, predicted int")


def trained(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> dict:
    sample = train_sample(spark, docs, labels)
    model = fit(sample)
    drop_stored(sample)
    return model


def drop_toxic(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is not predicted toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, beta = Matcher(model["lexicon"], model["exceptions"]), np.array(model["beta"])
        for batch in bounded(batches):
            x = features(batch.column("text"), matcher)
            yield batch.filter(pa.array(beta[0] + x @ beta[1:] < 0))

    return docs.mapInArrow(run, docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = trained(spark, docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return score(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")
