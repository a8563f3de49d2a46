"""Round trips through the writers and readers, and the written side tables.

Each query writes whole tables under the shared folder, reads them back and
returns what was read, so the check covers both directions.
"""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from shelfwise.operators import sampling, weights
from shelfwise.plans import prepare as plan
from shelfwise.plans.config import SplitConfig
from shelfwise.queries import cleaning, evaluation, inputs as I
from shelfwise.queries.registry import SQL, query
from shelfwise.session import scratch_path
from shelfwise.sources import sinks, tables


@query(
    f"""WITH {I.CATALOGUE} SELECT * REPLACE (round(price_numeric, 6) AS price_numeric,
  CASE WHEN description <> '' THEN description END AS description) FROM catalogue"""
)
def csv_round_trip(spark, d):
    """The whole catalogue as CSV: quotes, blanks and missing values survive."""
    path = sinks.write_table(I.catalogue(spark, d), scratch_path(spark, "books") + ".csv", "csv")
    return tables.read_catalogue(spark, path).withColumn("parent_asin", F.col("parent_asin").cast("bigint"))


@query(
    f"""WITH {I.REVIEWS} SELECT * REPLACE (replace(text, ' ', chr(10) || '"') AS text) FROM reviews"""
)
def review_csv(spark, d):
    """All reviews as CSV whose texts hold line breaks and quotes, read back typed."""
    broken = I.reviews(spark, d).withColumn("text", F.replace("text", F.lit(" "), F.lit('\n"')))
    path = sinks.write_table(broken, scratch_path(spark, "reviews") + ".csv", "csv")
    ids = {c: F.col(c).cast("bigint") for c in ("parent_asin", "user_id")}
    return tables.read_reviews(spark, path).withColumns(ids)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def parquet_round_trip(spark, d):
    path = sinks.write_table(I.table(spark, d, "documents"), scratch_path(spark, "documents") + ".parquet")
    return tables.read_table(spark, path)


@query(
    """WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY 1)
SELECT source, n, round((SELECT sum(n) FROM sizes)::DOUBLE / ((SELECT count(*) FROM sizes) * n), 6) AS weight FROM sizes"""
)
def json_weights_round_trip(spark, d):
    """Class weights as JSON; a missing file would read as None."""
    path = scratch_path(spark, "weights") + ".json"
    sinks.write_json(weights.class_weights(I.table(spark, d, "documents"), "source"), path)
    schema = T.StructType(
        [T.StructField("source", T.StringType()), T.StructField("n", T.LongType()), T.StructField("weight", T.DoubleType())]
    )
    return tables.read_optional_json(spark, path, schema)


_DOCS = I.class_query("documents", "lang", "doc_id")


@query(
    f"""WITH {_DOCS}, {I.quota_query()} SELECT k AS doc_id, ranked.c AS lang,
  CASE WHEN rn <= ranked.n - train_rows THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quotas ON ranked.c = quotas.c"""
)
def saved_splits(spark, d):
    """Load, split, save and re-read both parts."""
    config = SplitConfig(target="lang", key="doc_id")
    result = plan.run_split(spark, f"{d}/documents.parquet", scratch_path(spark, "splits"), config)
    parts = [result[s].select("doc_id", "lang", F.lit(s).alias("split")) for s in ("train", "test")]
    return parts[0].unionByName(parts[1])


@query(
    f"""WITH {_DOCS}, {I.quota_query()}, s AS (
  SELECT ranked.c AS lang, CASE WHEN rn <= ranked.n - train_rows THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quotas ON ranked.c = quotas.c)
SELECT row_number() OVER (ORDER BY lang) - 1 AS idx, lang AS class, count(*) FILTER (split = 'train') AS train_rows,
  count(*) FILTER (split = 'test') AS test_rows FROM s GROUP BY lang"""
)
def class_table(spark, d):
    """Index, name and rows per split of every class."""
    from shelfwise.plans.features import class_info
    from shelfwise.plans.stages import label_codes

    split = sampling.train_test_split(I.table(spark, d, "documents").select("doc_id", "lang"), "lang", 0.2, ["doc_id"])
    coded = label_codes(split, ["lang"])
    names = [r["lang"] for r in sampling.class_sizes(split, "lang").select("lang").orderBy("lang").collect()]
    return class_info(coded, names, "code_lang")


@query(
    f"""WITH {I.REVIEWS}, counts AS (SELECT rating, count(*) AS count, sum(count(*)) OVER () AS total FROM reviews GROUP BY 1)
SELECT rating, count, {I.half_even_sql('count / total * 100', 2)} AS percentage FROM counts"""
)
def summary_report_ratings(spark, d):
    """The whole data report is written; its rating section is read back."""
    from shelfwise.operators.profile import summary_sections

    paths = sinks.write_summary_report(
        summary_sections(spark, I.catalogue(spark, d), I.reviews(spark, d)), scratch_path(spark, "report")
    )
    return tables.read_optional_json(spark, paths["ratings"]).select("rating", "count", "percentage")


@query(SQL["prepared_table"])
def saved_prepared(spark, d):
    """The prepared table and its weights, saved and loaded."""
    root = scratch_path(spark, "prepared")
    stages = plan.prepare(I.raw_catalogue(spark, d), I.reviews(spark, d, True), cleaning.CONFIG)
    plan.save_prepared(stages.sampled, f"{root}/table", weights=stages.weights, weights_path=f"{root}/weights")
    return plan.load_prepared(spark, f"{root}/table").drop("has_series")


@query(SQL["model_comparison"])
def model_comparison_file(spark, d):
    """The comparison of models as a CSV file, read back."""
    compared = evaluation.model_comparison(spark, d)
    path = sinks.write_model_comparison(compared, scratch_path(spark, "comparison"))
    return spark.read.option("header", True).schema(compared.schema).csv(path)


@query(f"SELECT class, support FROM ({SQL['classification_report']})")
def classification_report_file(spark, d):
    """The classification report as aligned text, its classes and row counts read back."""
    path = sinks.write_classification_report(evaluation.classification_report(spark, d), scratch_path(spark, "classes"))
    line = F.col("value")
    support = F.trim(F.substring(line, 67, 12)).cast("bigint")
    return spark.read.text(path).select(F.trim(F.substring(line, 1, 30)).alias("class"), support.alias("support"))
