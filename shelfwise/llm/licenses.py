"""License scans with a positional rare-token index, in DataFrame functions only.

Templates are word sequences with a label and mandatory key phrases. Over the
whole corpus the document frequency of every template word is counted; the rarest
words of a template's key phrases are its anchors. Each place where an anchor stands in a
file gives, by its position in the template, a place where the template could
start. Such a start is kept if most of the template's anchors stand at their
relative positions, if the key phrases stand at theirs, and if enough of all
template words agree. Base phrases are templates that must agree in full.

A file is one row throughout: nothing is shuffled but the word counts, one row
per template word and task.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.llm.common import table

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANCHORS = 3
LEAST_ANCHORS = 2
LEAST_SHARE = 0.6

# Base phrases by label.
BASE = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

# Label, template, its mandatory key phrases.
TEMPLATES = [
    ("agpl-3", "licensed under the gnu affero general public license version 3", ["gnu affero general public license"]),
    ("apache-2", "you may not use this file except in compliance with the license", ["except in compliance with the license"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0 international"]),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ["creative commons attribution noncommercial"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc0", "dedicated to the public domain under the creative commons cc0 1 0 universal dedication", ["cc0 1 0 universal"]),
    ("gpl-2", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify and or distribute this software"]),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3", ["gnu lesser general public license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge"]),
    ("mit", "released under the mit license", ["under the mit license"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ["terms of the mozilla public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]


def split_words(text: str) -> list[str]:
    return [w for w in re.split(NOT_WORD, text.lower()) if w]


def place_of(part: list[str], whole: list[str]) -> int:
    return next(i for i in range(len(whole)) if whole[i : i + len(part)] == part)


def templates() -> list[dict]:
    """All templates, base phrases first, as words with the places of their key phrases."""
    out = [{"label": label, "base": True, "words": split_words(p), "keys": [(0, split_words(p))]} for label, p in BASE.items()]
    for label, text, keys in TEMPLATES:
        words = split_words(text)
        out.append({"label": label, "base": False, "words": words, "keys": [(place_of(split_words(k), words), split_words(k)) for k in keys]})
    return out


def words_of(text: str) -> Column:
    lower = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lower, NOT_WORD), lambda w: w != "")


def document_frequency(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """In how many rows each word of the bounded vocabulary stands; one row per word reaches the driver."""
    listed = F.array(*map(F.lit, vocabulary))
    found = docs.select(F.explode(F.array_intersect(words_of(text), listed)).alias("w")).groupBy("w").count().collect()
    return {**dict.fromkeys(vocabulary, 0), **{r.w: r["count"] for r in found}}


def anchors(template: dict, frequency: dict[str, int]) -> list[tuple[int, str]]:
    """The rarest distinct words of a template's key phrases at their first places; ties by the word."""
    place: dict[str, int] = {}
    for at, key in template["keys"]:
        for i, word in enumerate(key):
            place.setdefault(word, at + i)
    return [(place[w], w) for w in sorted(place, key=lambda w: (frequency[w], w))[:ANCHORS]]


def least_anchors(chosen: list) -> int:
    return min(LEAST_ANCHORS, len(chosen))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", known: list[dict] | None = None) -> DataFrame:
    """Per row: words, base places, labels and the best agreement with a template.

    Null and empty texts have no words, no labels and score 0. Equal rows are
    scanned one by one; labels that several templates share come once.
    """
    known = templates() if known is None else known
    frequency = document_frequency(docs, text, sorted({w for t in known for w in t["words"]}))
    chosen = [anchors(t, frequency) for t in known]
    def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
        """A column that is computed once per row: a generator is not merged into later expressions."""
        return rows.select("*", F.explode(F.array(value)).alias(name))

    rows = once(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("_text")), "w", words_of("_text"))
    listed = F.array(*[F.lit(w) for w in sorted({w for own in chosen for _, w in own})])
    hits = F.filter(F.transform("w", lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda h: F.array_contains(listed, h["w"]))
    none = F.array().cast("array<struct<i:int,w:string>>")
    rows = once(rows.select("doc_id", "w"), "hits", F.when(F.arrays_overlap("w", listed), hits).otherwise(none))

    def agreeing(words: list[tuple[int, str]]) -> str:
        return " + ".join(f"if(get(w, s + {at}) <=> '{word}', 1, 0)" for at, word in words)

    def found_of(t: dict, own: list[tuple[int, str]]) -> str:
        """SQL for where one template stands, with its agreement; words are plain letters and digits."""
        starts = ", ".join(f"transform(filter(hits, h -> h.w = '{word}'), h -> h.i - {at})" for at, word in own)
        keys = "".join(f" and slice(w, s + {at + 1}, {len(key)}) = array({', '.join(map(repr, key))})" for at, key in t["keys"])
        good = f"filter(array_distinct(concat({starts})), s -> s >= 0 and {agreeing(own)} >= {least_anchors(own)}{keys})"
        share = f"({agreeing(list(enumerate(t['words'])))}) / {len(t['words'])}"
        judged = f"transform({good}, s -> named_struct('at', s, 'label', '{t['label']}', 'base', {t['base']}, 'share', {share}))"
        return f"filter({judged}, f -> f.share >= {1.0 if t['base'] else LEAST_SHARE}D)"

    nothing = F.array().cast("array<struct<at:int,label:string,base:boolean,share:double>>")
    found = F.when(F.size("hits") > 0, F.expr(f"concat({', '.join(found_of(t, own) for t, own in zip(known, chosen))})")).otherwise(nothing)
    rows = once(rows, "found", found)
    base = F.filter("found", lambda f: f["base"])
    joined = lambda found: F.array_join(F.array_sort(F.array_distinct(found["label"])), ",")
    places = base["at"].cast("array<long>")
    return rows.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.col("found")["share"]), F.lit(0.0)).alias("score"),
    )


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels and base places of every document."""
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def _sql() -> str:
    def listed(words: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    rows = ",\n  ".join(f"({i}, '{t['label']}', {t['base']}, {listed(t['words'])}, {t['keys'][0][0]}, {listed(t['keys'][0][1])})" for i, t in enumerate(templates()))
    return f"""
WITH t(t, label, base, tw, kat, kw) AS (VALUES
  {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
tp AS (SELECT t, x, min(p) - 1 AS p FROM (SELECT t, unnest(kw) AS x, kat + generate_subscripts(kw, 1) AS p FROM t) GROUP BY t, x),
dw AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM d),
hit AS (SELECT dw.* FROM dw WHERE x IN (SELECT x FROM tp)),
df AS (SELECT x, count(DISTINCT r) AS n FROM hit GROUP BY x),
a AS (SELECT * FROM (SELECT t, x, p, row_number() OVER (PARTITION BY t ORDER BY coalesce(n, 0), x) AS k FROM tp LEFT JOIN df USING (x)) WHERE k <= {ANCHORS}),
need AS (SELECT t, least({LEAST_ANCHORS}, count(*)) AS least FROM a GROUP BY t),
s AS (SELECT r, t, i - p AS st, count(*) AS agree FROM hit JOIN a USING (x) WHERE i >= p GROUP BY ALL),
f AS (SELECT s.r, s.st, t.label, t.base,
    (SELECT count(*) FROM (SELECT unnest(t.tw) AS x, unnest(d.w[s.st + 1:s.st + len(t.tw)]) AS y) WHERE x = y) / len(t.tw) AS share
  FROM s JOIN t USING (t) JOIN need USING (t) JOIN d USING (r)
  WHERE s.agree >= need.least AND d.w[s.st + t.kat + 1:s.st + t.kat + len(t.kw)] = t.kw),
g AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(st) FILTER (WHERE base) AS first_word, max(st) FILTER (WHERE base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM f WHERE share >= CASE WHEN base THEN 1.0 ELSE {LEAST_SHARE} END GROUP BY r)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score FROM d LEFT JOIN g USING (r)"""


OP1_SQL = _sql()
