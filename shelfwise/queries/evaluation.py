"""Metric and ranking queries over labels and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import evaluation, ranking
from shelfwise.queries import inputs as I
from shelfwise.queries.registry import query


def _pairs(spark, d, prediction="1 - toxic"):
    return I.table(spark, d, "labels").select(
        F.col("quality").alias("label"), F.expr(prediction).alias("prediction")
    )


_PAIRS = "pairs AS (SELECT quality::BIGINT AS label, (1 - toxic)::BIGINT AS prediction FROM labels)"
_CLASSES = """classes AS (SELECT label AS class FROM pairs UNION SELECT prediction FROM pairs),
counts AS (
  SELECT class, count(*) FILTER (label = class) AS support, count(*) FILTER (prediction = class) AS predicted,
    count(*) FILTER (label = class AND prediction = class) AS hits FROM classes, pairs GROUP BY class),
scores AS (
  SELECT class, support, hits, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS p,
    CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r,
    CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * hits / (support + predicted) END AS f FROM counts),
overall AS (
  SELECT sum(hits) / sum(support) AS accuracy, sum(p * support) / sum(support) AS pw, avg(p) AS pm,
    sum(r * support) / sum(support) AS rw, avg(r) AS rm, sum(f * support) / sum(support) AS fw, avg(f) AS fm,
    sum(support)::BIGINT AS support FROM scores)"""


@query(f"WITH {_PAIRS} SELECT label, prediction, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY label), 6) AS share FROM pairs GROUP BY 1, 2")
def confusion_matrix(spark, d):
    return evaluation.confusion_matrix(_pairs(spark, d))


@query(
    f"""WITH {_PAIRS}, {_CLASSES} SELECT class, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1_score, support, hits FROM scores"""
)
def per_class_metrics(spark, d):
    return evaluation.per_class_metrics(_pairs(spark, d))


_OVERALL = """round(accuracy, 6) AS accuracy, round(pw, 6) AS precision_weighted, round(pm, 6) AS precision_macro,
  round(rw, 6) AS recall_weighted, round(rm, 6) AS recall_macro, round(fw, 6) AS f1_weighted, round(fm, 6) AS f1_macro, support"""


@query(f"WITH {_PAIRS}, {_CLASSES} SELECT {_OVERALL} FROM overall")
def overall_metrics(spark, d):
    return evaluation.overall_metrics(_pairs(spark, d))


@query(
    f"""WITH {_PAIRS}, {_CLASSES}
SELECT class::VARCHAR AS class, round(p, 4) AS "precision", round(r, 4) AS recall, round(f, 4) AS f1_score, support FROM scores
UNION ALL SELECT 'accuracy', NULL, NULL, round(accuracy, 4), support FROM overall
UNION ALL SELECT 'macro avg', round(pm, 4), round(rm, 4), round(fm, 4), support FROM overall
UNION ALL SELECT 'weighted avg', round(pw, 4), round(rw, 4), round(fw, 4), support FROM overall"""
)
def classification_report(spark, d):
    return evaluation.classification_report(_pairs(spark, d))


_SECOND = _PAIRS.replace("(1 - toxic)", "toxic")


def _comparison(spark, d):
    return evaluation.compare_models(
        {
            "not_toxic": evaluation.overall_metrics(_pairs(spark, d)),
            "toxic": evaluation.overall_metrics(_pairs(spark, d, "toxic")),
        }
    )


_COMPARE = f"""SELECT 'not_toxic' AS model, * FROM (WITH {_PAIRS}, {_CLASSES} SELECT {_OVERALL} FROM overall)
UNION ALL SELECT 'toxic' AS model, * FROM (WITH {_SECOND}, {_CLASSES} SELECT {_OVERALL} FROM overall)"""


@query(_COMPARE)
def model_comparison(spark, d):
    return _comparison(spark, d)


@query(f"SELECT * FROM ({_COMPARE}) ORDER BY f1_weighted DESC, model LIMIT 1")
def best_model(spark, d):
    return evaluation.best_model(_comparison(spark, d))


@query(
    f"""WITH folds AS (
  SELECT lang, (ntile(5) OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) - 1) AS fold, doc_id FROM documents),
scores AS (SELECT fold, avg(quality) AS score FROM folds JOIN labels USING (doc_id) GROUP BY 1)
SELECT count(*) AS folds, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std, round(min(score), 6) AS min, round(max(score), 6) AS max FROM scores"""
)
def fold_summary(spark, d):
    """Mean label quality per fold, summarised over the folds."""
    from shelfwise.operators.sampling import stratified_folds

    folds = stratified_folds(I.table(spark, d, "documents").select("doc_id", "lang"), "lang", 5, ["doc_id"])
    scores = folds.join(I.table(spark, d, "labels"), "doc_id").groupBy("fold").agg(F.avg("quality").alias("score"))
    return evaluation.fold_summary(scores)


@query(
    """WITH e AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
r AS (SELECT vec_id, i, v, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, i DESC) AS rank FROM e)
SELECT vec_id, rank, 'class_' || lpad(i::VARCHAR, 3, '0') AS class, round(v::DOUBLE, 6) AS score FROM r WHERE rank <= 3"""
)
def top_k_classes(spark, d):
    """The three largest components of every embedding, with their names."""
    names = F.transform(
        "embedding", lambda _, i: F.concat(F.lit("class_"), F.lpad(i.cast("string"), 3, "0"))
    )
    scores = F.transform("embedding", lambda v: v.cast("double"))
    rows = I.texts(spark, d, "embeddings")
    best = rows.select("vec_id", F.posexplode(ranking.top_k(scores, names, 3)).alias("i", "_b"))
    return best.select(
        "vec_id", (F.col("i") + 1).alias("rank"), "_b.class", F.col("_b.probability").alias("score")
    )


@query(
    """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
x AS (SELECT vec_id, i, exp(v - max(v) OVER (PARTITION BY vec_id)) AS p FROM e)
SELECT vec_id, i::BIGINT AS i, round(p / sum(p) OVER (PARTITION BY vec_id), 6) AS p FROM x"""
)
def softmax_scores(spark, d):
    scores = F.transform("embedding", lambda v: v.cast("double"))
    rows = I.texts(spark, d, "embeddings").withColumn("_s", scores)
    return rows.select("vec_id", F.posexplode(ranking.softmax(F.col("_s"))).alias("i", "p"))


@query(
    """WITH e AS (SELECT label::VARCHAR AS class, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
c AS (SELECT class, 'f' || lpad(i::VARCHAR, 3, '0') AS feature, avg(v) AS coefficient FROM e GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY coefficient, feature) AS lo,
  row_number() OVER (PARTITION BY class ORDER BY coefficient DESC, feature) AS hi FROM c)
SELECT class, feature, round(coefficient, 6) AS coefficient, lo AS rank, 'negative' AS side FROM r WHERE lo <= 5
UNION ALL SELECT class, feature, round(coefficient, 6), hi, 'positive' FROM r WHERE hi <= 5"""
)
def class_extremes(spark, d):
    """Per label, the five lowest and highest mean components."""
    return ranking.top_coefficients(_label_means(spark, d), 5)


def _label_means(spark, d):
    rows = I.table(spark, d, "embeddings").select(
        F.col("label").cast("string").alias("class"), F.posexplode("embedding").alias("i", "v")
    )
    return (
        rows.withColumn("feature", F.concat(F.lit("f"), F.lpad(F.col("i").cast("string"), 3, "0")))
        .groupBy("class", "feature")
        .agg(F.avg(F.col("v").cast("double")).alias("coefficient"))
    )


@query(
    """WITH e AS (SELECT generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
c AS (SELECT 'f' || lpad(i::VARCHAR, 3, '0') AS feature, stddev_pop(v) AS importance FROM e GROUP BY 1)
SELECT feature, round(importance, 6) AS importance FROM c ORDER BY c.importance DESC, feature LIMIT 20"""
)
def top_spread_components(spark, d):
    """The 20 embedding components of largest deviation, ranked as importances."""
    rows = I.table(spark, d, "embeddings").select(F.posexplode("embedding").alias("i", "v"))
    spread = (
        rows.withColumn("feature", F.concat(F.lit("f"), F.lpad(F.col("i").cast("string"), 3, "0")))
        .groupBy("feature")
        .agg(F.stddev_pop(F.col("v").cast("double")).alias("importance"))
    )
    return ranking.top_features(spread, 20)
