"""Sampling, splitting, fold and class-weight queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import sampling, weights
from shelfwise.queries import inputs as I
from shelfwise.queries.registry import query

_PART = I.class_query("part", "p_brand", "p_partkey")
_DOCS = I.class_query("documents", "lang", "doc_id")


def _parts(spark, d):
    return I.table(spark, d, "part").select("p_partkey", "p_brand")


def _docs(spark, d):
    return I.table(spark, d, "documents").select("doc_id", "lang")


@query(f"WITH {_PART} SELECT k AS p_partkey, c AS p_brand FROM ranked WHERE rn <= round_even(n * 0.5::DOUBLE, 0)")
def stratified_sample(spark, d):
    return sampling.stratified_sample(_parts(spark, d), "p_brand", 0.5, ["p_partkey"])


@query(
    f"WITH {_DOCS} SELECT k AS doc_id, c AS lang FROM ranked WHERE rn <= round_even(n * 0.3::DOUBLE, 0)"
)
def stratified_sample_documents(spark, d):
    return sampling.stratified_sample(_docs(spark, d), "lang", 0.3, ["doc_id"])


@query(f"WITH {_DOCS} SELECT k AS doc_id, c AS lang FROM ranked WHERE rn <= least(n, 120)")
def undersample(spark, d):
    """At most 120 rows of every language: the balancing feature itself."""
    return sampling.undersample(_docs(spark, d), "lang", 120, ["doc_id"])


@query(
    f"WITH {_DOCS} SELECT k AS doc_id, c AS lang FROM ranked "
    "WHERE rn <= least(n, floor((SELECT count(*) FROM rows_) * 0.1::DOUBLE))"
)
def undersample_to_share(spark, d):
    return sampling.undersample_to_share(_docs(spark, d), "lang", 0.1, ["doc_id"])


_SPLIT = f"""{_DOCS}, {I.quota_query()}, split AS (
  SELECT k, ranked.c, CASE WHEN rn <= ranked.n - train_rows THEN 'test' ELSE 'train' END AS split
  FROM ranked JOIN quotas ON ranked.c = quotas.c)"""


@query(f"WITH {_SPLIT} SELECT k AS doc_id, c AS lang, split FROM split")
def train_test_split(spark, d):
    return sampling.train_test_split(_docs(spark, d), "lang", 0.2, ["doc_id"])


@query(f"WITH {_PART}, {I.quota_query(0.25)} SELECT c AS p_brand, n, train_rows, n - train_rows AS test_rows FROM quotas")
def split_quotas(spark, d):
    return sampling.split_quotas(_parts(spark, d), "p_brand", 0.25)


@query(
    f"WITH {_DOCS} SELECT k AS doc_id, c AS lang, (ntile(5) OVER (PARTITION BY c ORDER BY md5('42:' || k), k) - 1)::BIGINT AS fold FROM ranked"
)
def stratified_folds(spark, d):
    return sampling.stratified_folds(_docs(spark, d), "lang", 5, ["doc_id"])


@query(
    f"WITH {_SPLIT}, counts AS (SELECT split, c AS lang, count(*) AS count, sum(count(*)) OVER (PARTITION BY split) AS total "
    f"FROM split GROUP BY split, c) SELECT split, lang, count, {I.half_even_sql('count / total * 100', 1)} AS percentage FROM counts"
)
def split_distribution(spark, d):
    return sampling.split_distribution(train_test_split(spark, d), "lang")


@query(
    f"""WITH {_SPLIT} SELECT 0.2::DOUBLE AS test_size, 42::BIGINT AS random_state, 'lang' AS target_column,
  count(*) AS total_samples, count(*) FILTER (split = 'train') AS train_samples,
  count(*) FILTER (split = 'test') AS test_samples, count(DISTINCT c) FILTER (split = 'train') AS n_classes,
  string_agg(DISTINCT c, ',' ORDER BY c) AS classes,
  (SELECT string_agg(c || ':' || n, ',' ORDER BY c) FROM (SELECT c, count(*) AS n FROM split WHERE split = 'train' GROUP BY c)) AS train_distribution,
  (SELECT string_agg(c || ':' || n, ',' ORDER BY c) FROM (SELECT c, count(*) AS n FROM split WHERE split = 'test' GROUP BY c)) AS test_distribution
FROM split"""
)
def split_summary(spark, d):
    summary = sampling.split_summary(train_test_split(spark, d), "lang")
    flat = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws(":", e["key"], e["value"])), ",").alias(c)
    maps = ("train_distribution", "test_distribution")
    rest = [c for c in summary.columns if c not in (*maps, "classes")]
    return summary.select(*rest, F.array_join("classes", ",").alias("classes"), *[flat(c) for c in maps])


@query(
    f"WITH {_SPLIT} SELECT c AS lang, bool_or(split = 'train') AS in_train, bool_or(split = 'test') AS in_test FROM split GROUP BY 1"
)
def split_coverage(spark, d):
    return sampling.split_coverage(train_test_split(spark, d), "lang")


@query(
    f"""WITH rows_ AS (SELECT source AS c, doc_id AS k FROM documents),
marked AS (SELECT c, CASE WHEN c IN (SELECT DISTINCT source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))
  THEN 'test' ELSE 'train' END AS split FROM rows_)
SELECT c AS source, CASE WHEN bool_or(split = 'train') THEN 'test' ELSE 'train' END AS missing_in
FROM marked GROUP BY c HAVING count(DISTINCT split) = 1"""
)
def missing_classes(spark, d):
    """Sources divided by whether any of their documents is toxic."""
    docs = I.table(spark, d, "documents").select("doc_id", "source")
    toxic = (
        I.table(spark, d, "labels").where("toxic = 1").join(docs, "doc_id").select("source").distinct()
    )
    marked = docs.join(toxic.withColumn("split", F.lit("test")), "source", "left").fillna("train", ["split"])
    return sampling.missing_classes(marked, "source")


@query(
    f"""WITH {_PART}, per_class AS (SELECT c, n, least(n, round_even(n * 0.5::DOUBLE, 0)) AS q FROM ranked GROUP BY c, n)
SELECT c AS p_brand, n AS count_before, {I.half_even_sql('n / (SELECT sum(n) FROM per_class) * 100', 1)} AS percentage_before,
  {I.half_even_sql('q / (SELECT sum(q) FROM per_class) * 100', 1)} AS percentage_after
FROM per_class ORDER BY n DESC, c LIMIT 5"""
)
def sample_distribution(spark, d):
    """The five largest brands before and after sampling."""
    return sampling.sample_distribution(_parts(spark, d), stratified_sample(spark, d), "p_brand")


_WEIGHTS = """sizes AS (SELECT source AS c, count(*) AS n FROM labelled GROUP BY 1),
balanced AS (SELECT c, n, (SELECT sum(n) FROM sizes)::DOUBLE / ((SELECT count(*) FROM sizes) * n) AS weight FROM sizes)"""
_LABELLED = "labelled AS (SELECT doc_id, source, lang FROM documents)"
_LANG_WEIGHTS = _WEIGHTS.replace("source", "lang").replace("labelled", "documents")
_AGGRESSIVE = "raised AS (SELECT c, n, pow(weight, 1.2::DOUBLE) AS w FROM balanced), strong AS (SELECT c, n, w / (SELECT avg(w) FROM raised) AS weight FROM raised)"


def _labelled(spark, d):
    """All documents; their sources are classes of unequal size."""
    return I.table(spark, d, "documents").select("doc_id", "source", "lang")


@query(f"WITH {_LABELLED}, {_WEIGHTS} SELECT c AS source, n, round(weight, 6) AS weight FROM balanced")
def class_weights(spark, d):
    return weights.class_weights(_labelled(spark, d), "source")


@query(
    f"WITH {_LABELLED}, {_WEIGHTS} SELECT c AS source, n, round(weight, 6) AS weight FROM balanced ORDER BY balanced.weight DESC, c LIMIT 5"
)
def minority_classes(spark, d):
    return weights.minority_classes(_labelled(spark, d), "source")


@query(f"WITH {_LABELLED}, {_WEIGHTS}, {_AGGRESSIVE} SELECT c AS source, n, round(weight, 6) AS weight FROM strong")
def aggressive_weights(spark, d):
    return weights.aggressive_weights(_labelled(spark, d), "source")


@query(
    f"""WITH {_LABELLED}, {_WEIGHTS}, {_AGGRESSIVE}
SELECT * FROM (SELECT c AS source, n, round(weight, 6) AS weight, 'highest' AS "end" FROM strong ORDER BY strong.weight DESC, c LIMIT 10)
UNION ALL
SELECT * FROM (SELECT c AS source, n, round(weight, 6) AS weight, 'lowest' AS "end" FROM strong ORDER BY strong.weight, c LIMIT 10)"""
)
def weight_extremes(spark, d):
    return weights.weight_extremes(weights.aggressive_weights(_labelled(spark, d), "source"), "source")


_BANDS = f"""sizes AS (SELECT source AS c, count(*) AS n, sum(count(*)) OVER () AS total FROM labelled GROUP BY 1),
report AS (SELECT c AS source, n AS samples, {I.half_even_sql('n / total * 100', 2)} AS percentage,
  CASE WHEN n < total * 0.01::DOUBLE THEN 'small' WHEN n > total * 0.1::DOUBLE THEN 'dominant' ELSE 'normal' END AS band FROM sizes)"""


@query(f"WITH {_LABELLED}, {_BANDS} SELECT * FROM report")
def imbalance_report(spark, d):
    return weights.imbalance_report(_labelled(spark, d), "source")


# The quality of labelled documents per source gives small and dominant classes.
_PAIRS = "labelled AS (SELECT doc_id, lang || quality || toxic AS source FROM documents JOIN labels USING (doc_id))"


@query(
    f"""WITH {_PAIRS}, {_BANDS}, advice AS (
  SELECT *, CASE WHEN band = 'small' AND samples < 20 THEN 'critical' WHEN band = 'small' THEN 'few samples' ELSE 'dominant' END AS finding
  FROM report WHERE band <> 'normal')
SELECT source, samples, percentage, finding, unnest(CASE finding
  WHEN 'critical' THEN ['remove class', 'merge with similar class', 'get more data']
  WHEN 'few samples' THEN ['use aggressive class weights', 'apply oversampling']
  ELSE ['undersample to 10 % of rows', 'use class weights'] END) AS action FROM advice"""
)
def recommendations(spark, d):
    return weights.recommendations(_label_pairs(spark, d), "source")


def _label_pairs(spark, d):
    return (
        I.table(spark, d, "documents")
        .join(I.table(spark, d, "labels"), "doc_id")
        .select("doc_id", F.concat("lang", F.col("quality").cast("string"), F.col("toxic").cast("string")).alias("source"))
    )


@query(
    f"""WITH {_PAIRS}, sizes AS (SELECT source, count(*) AS n FROM labelled GROUP BY 1),
spread AS (SELECT sum(n)::BIGINT AS total_samples, count(*) AS n_classes, round(avg(n), 6) AS mean_samples, median(n::DOUBLE) AS median_samples,
  round(stddev_pop(n), 6) AS std_samples, min(n) AS min_samples, max(n) AS max_samples, max(n) / min(n) AS r FROM sizes)
SELECT * EXCLUDE (r), round(r, 6) AS imbalance_ratio, CASE WHEN r > 50 THEN 'severe' WHEN r > 20 THEN 'high' WHEN r > 10 THEN 'moderate' ELSE 'acceptable' END AS severity FROM spread"""
)
def class_spread(spark, d):
    return weights.class_spread(_label_pairs(spark, d), "source")


@query(
    f"""WITH {_LANG_WEIGHTS} SELECT doc_id, lang, round(weight, 6) AS sample_weight FROM documents JOIN balanced ON lang = c"""
)
def sample_weights(spark, d):
    docs = _docs(spark, d)
    return weights.sample_weights(docs, weights.class_weights(docs, "lang"), "lang")


@query(
    f"WITH {_LABELLED} SELECT DISTINCT text AS text FROM benchmark WHERE text NOT IN (SELECT text FROM documents)"
)
def missing_from_weights(spark, d):
    """Benchmark texts without a weight in a table made from the documents."""
    known = weights.class_weights(I.table(spark, d, "documents").select("text"), "text")
    return weights.missing_from_weights(I.table(spark, d, "benchmark"), known, "text")


@query(
    f"""WITH {_LANG_WEIGHTS} SELECT c AS lang, n, round(weight, 6) AS weight FROM balanced"""
)
def resolved_weights(spark, d):
    """A weight table that lacks classes is replaced by balanced weights."""
    docs = _docs(spark, d)
    partial = weights.class_weights(docs.where("lang <> 'en'"), "lang")
    return weights.resolve_weights(docs, partial, "lang")
