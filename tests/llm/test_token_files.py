import zlib

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import token_files
from shelfwise.llm.common import shared_path

SCHEMA = "doc_id long, text string, file string, base long"
TEXTS = [
    "The quick, brown fox!!  jumps\tover 12 dogs' it's",
    "",
    None,
    "ÀÉ étude Straße ÑANDÚ ... ||| a||b x,.y don't DON'T 'S 'll!",
    "<|endoftext|> and <|ENDOFTEXT|> <|startoftext|>x",
    " no break space　wide \x85 next",
    "日本語のテキスト, 한국어. العربية! İstanbul ΣΑΣ",
    "word " * 3000,
    "a,b.c;d:e!f?g|h$i%j&k*l#m",
]


def want(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def test_encoder_equals_the_tokenizer():
    encoder = token_files.Encoder(token_files.tokenizer_path(), "<u2")
    flat, lengths = encoder.documents(pa.array(TEXTS), 2)
    cut = np.split(flat, np.cumsum(lengths)[:-1])
    assert [list(map(int, c)) for c in cut] == want(TEXTS)


def test_files_round_trip(spark):
    rows = [(i * 7 % 9, t, "f", 1) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "g", 2), (None, "null id", "h", 3)]
    folder = shared_path(spark, "tokens")
    manifest = token_files.write_token_files(spark.createDataFrame(rows, SCHEMA).repartition(3), folder, token_files.tokenizer_path())
    assert {m.dtype for m in manifest.collect()} == {"<u2"}
    got = token_files.read_token_files(token_files.read_manifest(spark, folder)).orderBy("start").collect()
    texts = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [g.doc_id for g in got] == [r[0] for r in texts]
    start = 0
    for g, ids in zip(got, want([r[1] for r in texts])):
        assert (g.start, g.n_tokens) == (start, len(ids))
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_empty_table(spark):
    assert token_files.token_table(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_over_the_table(spark, sf_dir):
    got = {r.doc_id: r for r in token_files.op10_token_files(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for d, ids in zip(docs, want([d.text for d in docs])):
        assert tuple(got[d.doc_id]) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(docs)


@pytest.mark.parametrize("cached", [0, 5])
def test_a_full_cache_changes_nothing(cached):
    encoder = token_files.Encoder(token_files.tokenizer_path(), "<u2", cached)
    for _ in range(2):
        flat, _ = encoder.documents(pa.array(TEXTS), 2)
        assert flat.tolist() == [i for w in want(TEXTS) for i in w]
