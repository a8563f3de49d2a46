"""Training, cross-validation and scoring on the enriched catalogue.

Features and models are fitted once per session and folder, saved, and loaded by
every query that needs them. Models have no SQL twin; the features have.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.functions.text import has_series
from shelfwise.operators import evaluation
from shelfwise.operators.aggregates import enrich_with_reviews
from shelfwise.operators.cleaning import clean_catalogue, clean_reviews
from shelfwise.operators.sampling import train_test_split
from shelfwise.plans import selection, training
from shelfwise.plans.features import FeatureConfig, FittedFeatures, dataset_summary, fit_features, load_features
from shelfwise.plans.scoring import Classifier
from shelfwise.queries import inputs as I
from shelfwise.queries.registry import query
from shelfwise.session import cut_lineage, scratch_path
from shelfwise.sources.models import load_model, save_model
from shelfwise.sources.sinks import write_features
from shelfwise.streaming.scoring import read_answers, request_stream, score_stream

FEATURES = FeatureConfig(max_features=8000, ngram_range=(1, 3))
LOGISTIC = training.LogisticConfig()
FOREST = training.ForestConfig()
# Rounds and depth of the boosted models are cut; the README has figures.
BOOSTED = training.BoostedConfig(n_estimators=5, max_depth=3)
JOINT = training.BoostedConfig(n_estimators=5, max_depth=4, objective="softmax")
LABEL = FEATURES.label
_SAVED: dict[tuple, str] = {}


def _once(spark, d, name, make):
    """The path that ``make(path)`` filled, made once per session and folder."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _SAVED:
        path = scratch_path(spark, name)
        make(path)
        _SAVED[key] = path
    return _SAVED[key]


def _enriched(spark, d):
    """The cleaned catalogue with review features and the series flag of raw titles."""
    flagged = I.raw_catalogue(spark, d).withColumn("has_series", has_series(F.col("title")))
    return enrich_with_reviews(clean_catalogue(flagged), clean_reviews(I.reviews(spark, d, long_work=True)))


def _split(spark, d):
    """All books, split by category, written once."""
    split = lambda path: train_test_split(_enriched(spark, d), S.TARGET, 0.2).write.parquet(path)
    return spark.read.parquet(_once(spark, d, "split", split))


def _fitted(spark, d):
    fit = lambda path: fit_features(_split(spark, d).where("split = 'train'"), FEATURES).save(spark, path)
    return FittedFeatures.load(spark, _once(spark, d, "fitted", fit))


def _featured(spark, d):
    """The fitted features and the stored feature table."""
    fitted = _fitted(spark, d)
    columns = (S.KEY, "split", LABEL, "features")
    path = _once(spark, d, "featured", lambda path: write_features(fitted.transform(_split(spark, d)).select(*columns), path))
    return fitted, load_features(spark, path)


def _model(spark, d, name, fit):
    """A model fitted on the training rows, as saved and loaded."""

    def make(path):
        fitted, featured = _featured(spark, d)
        save_model(spark, fit(featured.where("split = 'train'")), path, class_names=fitted.class_names)

    return load_model(spark, _once(spark, d, name, make))[0]


def _logistic(spark, d):
    return _model(spark, d, "logistic", lambda train: training.train_logistic(train, LOGISTIC, label=LABEL))


def _boosted(spark, d):
    def fit(train):
        return training.train_boosted(train, BOOSTED, training.aggressive_class_weights(train, LABEL), LABEL)

    return _model(spark, d, "boosted", fit)


def _joint(spark, d):
    return _model(spark, d, "joint", lambda train: training.train_boosted(train, JOINT, label=LABEL, balanced=True))


def _forest(spark, d):
    return _model(spark, d, "forest", lambda train: training.train_forest(train, FOREST, label=LABEL))


def _tested(spark, d, model):
    _, featured = _featured(spark, d)
    return training.predict(model, featured.where("split = 'test'"), LABEL)


# The text of a row: cleaned title and description without stop words, as runs of one to three words.
_TERMS = f"""{I.ENRICHED}, rows_ AS (SELECT category_level_2_sub AS c, parent_asin AS k FROM enriched),
ranked AS (SELECT c, k, row_number() OVER (PARTITION BY c ORDER BY md5('42:' || k), k) AS rn FROM rows_),
{I.quota_query()},
split AS (
  SELECT k AS parent_asin, ranked.c AS category, CASE WHEN rn <= quotas.n - train_rows THEN 'test' ELSE 'train' END AS split
  FROM ranked JOIN quotas ON ranked.c = quotas.c),
classes AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS label FROM split WHERE split = 'train' GROUP BY category),
words AS (
  SELECT parent_asin, split, list_filter(regexp_extract_all(lower(concat_ws(' ', title, description)), '\\b\\w\\w+\\b'),
    lambda w: NOT list_contains({list(I.STOP_WORDS)}, w)) AS ws
  FROM enriched JOIN split USING (parent_asin)),
terms AS (
  SELECT parent_asin, split, unnest(ws) AS term FROM words
  UNION ALL SELECT parent_asin, split, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM words
  UNION ALL SELECT parent_asin, split, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM words),
tf AS (SELECT parent_asin, split, term, count(*) AS tf FROM terms GROUP BY ALL),
n_train AS (SELECT count(*) AS n FROM split WHERE split = 'train'),
vocab AS (
  SELECT term, sum(tf)::BIGINT AS total, ln((1 + (SELECT n FROM n_train)) / (1 + count(*))) + 1 AS idf
  FROM tf WHERE split = 'train' GROUP BY term HAVING count(*) >= 2 AND count(*) <= 0.95::DOUBLE * (SELECT n FROM n_train)
  ORDER BY 2 DESC, 1 LIMIT {FEATURES.max_features}),
names AS (
  SELECT (row_number() OVER (ORDER BY term) - 1)::BIGINT AS idx, term FROM vocab)"""
_OTHERS = [("numerical", c) for c in S.NUMERIC_FEATURES] + [("categorical", c) for c in S.CATEGORICAL_FEATURES] + [("engineered", c) for c in S.ENGINEERED_FEATURES]
_OTHER_ROWS = " ".join(
    f"UNION ALL SELECT (SELECT count(*) FROM names) + {i}, '{name}', '{block}', NULL" for i, (block, name) in enumerate(_OTHERS)
)


@query(
    f"""WITH {_TERMS}, weights AS (SELECT parent_asin, tf * idf AS w FROM tf JOIN vocab USING (term)),
norms AS (SELECT parent_asin, sqrt(sum((w / norm) * (w / norm))) AS text_norm, sum(w / norm) AS text_total FROM weights
  JOIN (SELECT parent_asin, sqrt(sum(w * w)) AS norm FROM weights GROUP BY 1) USING (parent_asin) GROUP BY 1)
SELECT parent_asin, split, label::DOUBLE AS label, (SELECT count(*) FROM vocab) + {len(_OTHERS)} AS n_features,
  round(coalesce(text_norm, 0), 6) AS text_norm, round(coalesce(text_total, 0), 6) AS text_total
FROM split JOIN classes USING (category) LEFT JOIN norms USING (parent_asin)"""
)
def feature_matrix(spark, d):
    """Features of every book: label, size, and norm and sum of the text block."""
    fitted, featured = _featured(spark, d)
    text = F.slice(vector_to_array("features"), 1, len(fitted.names["text"]))
    # Only stored entries are summed; the array lives inside one expression.
    held = F.filter(text, lambda x: x != 0)
    return featured.select(
        S.KEY,
        "split",
        LABEL,
        F.lit(len(fitted.feature_names)).alias("n_features"),
        F.sqrt(F.aggregate(held, F.lit(0.0), lambda a, x: a + x * x)).alias("text_norm"),
        F.aggregate(held, F.lit(0.0), lambda a, x: a + x).alias("text_total"),
    )


@query(f"WITH {_TERMS} SELECT idx, 'tfidf_' || idx AS name, 'text' AS block, term FROM names {_OTHER_ROWS}")
def feature_names(spark, d):
    """Index, name, block and term of every fitted feature."""
    return _fitted(spark, d).feature_table(spark)


@query(
    f"""WITH {_TERMS} SELECT count(*) FILTER (split = 'train') AS train_samples, count(*) FILTER (split = 'test') AS test_samples,
  count(*) AS total_samples, round(count(*) FILTER (split = 'test') / count(*), 6) AS test_split_ratio,
  (SELECT count(*) FROM vocab) + {len(_OTHERS)} AS total_features, (SELECT count(*) FROM vocab) AS text_features,
  {len(S.NUMERIC_FEATURES)}::BIGINT AS numerical_features, {len(S.CATEGORICAL_FEATURES)}::BIGINT AS categorical_features,
  {len(S.ENGINEERED_FEATURES)}::BIGINT AS engineered_features, (SELECT count(*) FROM classes) AS n_classes,
  (SELECT string_agg(category, ',' ORDER BY category) FROM classes) AS class_names
FROM split JOIN classes USING (category)"""
)
def feature_dataset_summary(spark, d):
    """Rows, features and classes of the feature table."""
    fitted, featured = _featured(spark, d)
    return dataset_summary(featured, fitted).withColumn("class_names", F.array_join("class_names", ","))


@query(f"WITH {_TERMS} SELECT split, label::DOUBLE AS label, count(*) AS n FROM split JOIN classes USING (category) GROUP BY ALL")
def saved_labels(spark, d):
    """Rows per split and label of the stored feature table."""
    return _featured(spark, d)[1].groupBy("split", LABEL).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_TERMS} SELECT label AS idx, category AS class FROM classes")
def saved_model_classes(spark, d):
    """The class names a saved model carries, by index."""
    _logistic(spark, d)
    names = load_model(spark, _SAVED[spark.sparkContext.applicationId, d, "logistic"])[1]["class_names"]
    return spark.createDataFrame(list(enumerate(names)), "idx int, class string")


@query()
def train_logistic(spark, d):
    """Logistic regression with balanced weights: overall test metrics."""
    return evaluation.overall_metrics(_tested(spark, d, _logistic(spark, d)))


@query()
def train_boosted(spark, d):
    """Boosted trees per class with aggressive weights: per-class test metrics."""
    return evaluation.per_class_metrics(_tested(spark, d, _boosted(spark, d)))


@query()
def train_joint_boosted(spark, d):
    """Boosted trees of all classes at once with balanced weights: per-class test metrics."""
    return evaluation.per_class_metrics(_tested(spark, d, _joint(spark, d)))


@query()
def joint_boosted_losses(spark, d):
    """Training log loss of the joint model after each round."""
    history = _joint(spark, d).history
    return spark.createDataFrame([(i + 1, float(h[0])) for i, h in enumerate(history)], "round int, loss double")


@query()
def train_forest(spark, d):
    """Random forest: overall test metrics."""
    return evaluation.overall_metrics(_tested(spark, d, _forest(spark, d)))


@query()
def cross_validate(spark, d):
    """Weighted F1 of each of three stratified folds."""
    _, featured = _featured(spark, d)
    return selection.cross_validate(
        featured.where("split = 'train'"),
        lambda rows: training.train_logistic(rows, LOGISTIC, label=LABEL, balanced=False),
        [S.KEY],
        folds=3,
        label=LABEL,
    )


@query()
def feature_importance(spark, d):
    """The 20 most important features of the boosted model."""
    return training.feature_importance(spark, _boosted(spark, d), _fitted(spark, d).feature_names, 20)


@query()
def coefficients(spark, d):
    """The 10 lowest and highest logistic coefficients of every class."""
    fitted = _fitted(spark, d)
    return training.coefficient_importance(spark, _logistic(spark, d), fitted.feature_names, fitted.class_names, 10)


@query()
def trained_model_comparison(spark, d):
    """Logistic regression against a forest and the joint trees on the same features."""
    models = {"logistic": _logistic(spark, d), "forest": _forest(spark, d), "joint": _joint(spark, d)}
    return selection.choose_model({name: evaluation.overall_metrics(_tested(spark, d, m)) for name, m in models.items()})[0]


def _requests(spark, d):
    """Every book as a scoring request: title, description, price, rating, count and format."""
    return _split(spark, d).select(
        S.KEY,
        "title",
        "description",
        F.col("price_numeric").alias("price"),
        F.col("average_rating").alias("rating"),
        F.col("rating_number").cast("int").alias("rating_count"),
        F.col("format").alias("book_format"),
    )


def _flat(scored):
    top = F.transform("top_3", lambda p: F.concat_ws(":", p["class"], F.format_number(p["probability"], 6)))
    return scored.select(S.KEY, "predicted_class", "confidence", F.array_join(top, ",").alias("top_3"))


@query()
def score_batch(spark, d):
    """Class, confidence and top three with probabilities of every book."""
    return _flat(Classifier(_fitted(spark, d), _logistic(spark, d)).score(_requests(spark, d)))


@query()
def score_stream_files(spark, d):
    """The same answers from the streaming job over request files."""
    requests = cut_lineage(_requests(spark, d), "requests")
    folder = requests.inputFiles()[0].rsplit("/", 1)[0]
    output = scratch_path(spark, "scored")
    classifier = Classifier(_fitted(spark, d), _logistic(spark, d))
    score_stream(classifier, request_stream(spark, folder, requests.schema), output, scratch_path(spark, "stream")).awaitTermination()
    return _flat(read_answers(spark, output))
