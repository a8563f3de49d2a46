"""Features, training, selection and scoring on a small labelled corpus."""

import math
import random

import pytest
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.operators.evaluation import overall_metrics
from shelfwise.operators.tfidf import TermConfig, tfidf_weights
from shelfwise.plans import features as PF
from shelfwise.plans import selection, training
from shelfwise.plans.scoring import Classifier
from shelfwise.plans.stages import CodedColumns, dense_codes, label_codes, standardized
from shelfwise.session import scratch_path
from shelfwise.sources.models import default_model_path, load_model, save_model
from shelfwise.streaming.scoring import manifest, read_answers, request_stream, score_stream

WORDS = {
    "cooking": "recipe oven salt butter taste kitchen",
    "history": "king war empire century battle crown",
    "space": "planet orbit rocket star galaxy comet",
}
SHARED = "book about the story of people and their time"
SCHEMA = (
    "id int, title string, description string, category_level_2_sub string, price_numeric double, "
    "average_rating double, review_count int, format string"
)


def corpus(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        c = rng.choice(list(WORDS))
        body = " ".join(rng.choices(WORDS[c].split() + SHARED.split(), k=12))
        rows.append(
            (i, f"volume {i}" if i % 2 else "tale", body, c, rng.choice([None, 5.0, 15.0, 60.0]), rng.choice([0.0, 3.0, 4.6]),
             rng.randrange(50), rng.choice(["Paperback", "Kindle", None]))
        )
    return rows


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(corpus(160, 1), SCHEMA).cache()


@pytest.fixture(scope="module")
def test(spark):
    return spark.createDataFrame(corpus(60, 2), SCHEMA).cache()


@pytest.fixture(scope="module")
def fitted(train):
    return PF.fit_features(train, PF.FeatureConfig(max_features=60, ngram_range=(1, 2)))


@pytest.fixture(scope="module")
def featured(fitted, train):
    return fitted.transform(train).cache()


@pytest.fixture(scope="module")
def logistic(featured):
    return training.train_logistic(featured, training.LogisticConfig(max_iter=50))


@pytest.fixture(scope="module")
def boosted(featured):
    return training.train_boosted(featured, training.BoostedConfig(n_estimators=6, max_depth=3))


def test_feature_layout(fitted, featured):
    breakdown = fitted.stats()["feature_breakdown"]
    assert breakdown == {"text": 60, "numerical": 3, "categorical": 3, "engineered": 5}
    row = featured.first()
    assert row.features.size == len(fitted.feature_names) == 71
    assert fitted.block_of("tfidf_3") == "text" and fitted.block_of("title_length") == "engineered"
    assert fitted.block_of("nothing") == "unknown"
    assert fitted.class_names == sorted(WORDS)


def test_text_block_equals_relational_weights(spark, fitted, train):
    from pyspark.ml.feature import StopWordsRemover

    stop = tuple(StopWordsRemover.loadDefaultStopWords("english"))
    config = TermConfig(60, (1, 2), stop_words=stop)
    text = train.select("id", F.concat_ws(" ", "title", "description").alias("text"))
    want = {(r.id, r.term): r.weight for r in tfidf_weights(text, "id", "text", config).collect()}
    terms = [r.term for r in fitted.feature_table(spark).where("block = 'text'").orderBy("idx").collect()]
    assert terms == sorted(terms)
    got = {}
    for r in fitted.transform_inference(train).select("id", "features").collect():
        vector = r.features.toArray()[: len(terms)]
        got |= {(r.id, t): w for t, w in zip(terms, vector) if w}
        assert math.isclose(sum(w * w for w in vector), 1.0) or not vector.any()
    assert got == pytest.approx(want)


def test_features_stay_sparse(spark):
    rows = [(i, "t", f"alpha{i % 40} beta{i % 30} gamma", "x" if i % 2 else "y") for i in range(200)]
    df = spark.createDataFrame(rows, "id int, title string, description string, category_level_2_sub string")
    wide = PF.fit_features(df, PF.FeatureConfig(max_features=200, ngram_range=(1, 3)))
    assert "Sparse" in type(wide.transform(df).first().features).__name__


def test_tfidf_formula(spark):
    docs = ["apple pear", "apple apple plum", "plum pear apple", "fig", "apple"]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, text string")
    got = {(r.id, r.term): r.weight for r in tfidf_weights(df, "id", "text", TermConfig(10, max_df=0.9)).collect()}
    idf = {t: math.log(6 / (1 + n)) + 1 for t, n in {"apple": 4, "pear": 2, "plum": 2}.items()}
    norm = math.hypot(2 * idf["apple"], idf["plum"])
    assert got[1, "apple"] == pytest.approx(2 * idf["apple"] / norm)
    assert got[4, "apple"] == 1.0 and (3, "fig") not in got


def test_standardise_constant_and_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    got = standardized(df, ["a", "b"]).orderBy("a").select("std_a", "std_b").collect()
    assert [tuple(r) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]


def test_unseen_values(spark, fitted):
    rows = [(1, "t", "recipe", "unheard of", 5.0, 3.0, 1, "Stone tablet"), (2, "t", "king", None, 5.0, 3.0, 1, "Kindle")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert fitted.transform(df).count() == 0
    first = PF.FittedFeatures(
        PF.FeatureConfig(max_features=60, handle_invalid="first"), fitted.stages, fitted.target, fitted.names
    )
    assert [r.label for r in first.transform(df).collect()] == [0.0, 0.0]
    codes = fitted.transform_inference(df).select(vector_to_array("features")[63].alias("f")).collect()
    assert [r.f for r in codes] == [0.0, 0.0]


def test_one_hot_encoding(train):
    hot = PF.fit_features(train, PF.FeatureConfig(max_features=20, encoding="onehot"))
    assert "format=Kindle" in hot.names["categorical"]
    assert hot.transform(train).first().features.size == len(hot.feature_names)


def test_fit_errors(train):
    with pytest.raises(ValueError, match="not found"):
        PF.fit_features(train.drop("category_level_2_sub"), PF.FeatureConfig(max_features=5))
    with pytest.raises(ValueError, match="no labelled rows"):
        PF.fit_features(train.limit(0), PF.FeatureConfig(max_features=5))
    with pytest.raises(ValueError):
        PF.FeatureConfig(max_features=5, encoding="binary")


def test_save_and_load_features(spark, fitted, test):
    path = scratch_path(spark, "features-model")
    fitted.save(spark, path)
    loaded = PF.FittedFeatures.load(spark, path)
    assert loaded.config == fitted.config and loaded.names == fitted.names and loaded.medians == fitted.medians
    want = fitted.transform(test).orderBy("id").collect()
    got = loaded.transform(test).orderBy("id").collect()
    assert [r.features for r in got] == [r.features for r in want]
    with pytest.raises(FileNotFoundError):
        PF.FittedFeatures.load(spark, scratch_path(spark, "nowhere"))


def test_saved_feature_bundle(spark, fitted, train, test):
    split = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    out = scratch_path(spark, "bundle")
    paths = PF.save_features_and_metadata(split, fitted, out, f"{out}/model")
    assert PF.load_features(spark, paths["features"]).count() == 220
    summary = spark.read.json(paths["summary"]).first()
    assert summary["test_split_ratio"] == pytest.approx(60 / 220) and summary["total_features"] == 71
    classes = spark.read.json(paths["class_info"]).orderBy("idx").collect()
    assert [r["class"] for r in classes] == sorted(WORDS)
    assert sum(r["train_rows"] for r in classes) == 160 and sum(r["test_rows"] for r in classes) == 60


def test_models_learn(fitted, logistic, boosted, test):
    held_out = fitted.transform(test)
    for model in (logistic, boosted):
        assert overall_metrics(training.predict(model, held_out)).first()["accuracy"] > 0.85


def test_probabilities(boosted, logistic, featured):
    for model in (boosted, logistic):
        rows = training.with_probabilities(model, featured).select("probability", "prediction").collect()
        assert all(sum(r.probability) == pytest.approx(1) and len(r.probability) == 3 for r in rows)
        assert all(r.probability[int(r.prediction)] == max(r.probability) for r in rows)


def test_boosted_prediction_equals_spark_one_vs_rest(boosted, featured):
    ours = training.with_probabilities(boosted, featured).select("id", F.col("prediction").alias("p"))
    theirs = boosted.transform(featured).select("id", "prediction")
    assert ours.join(theirs, "id").where("p <> prediction").count() == 0


def test_boosted_stops_early_on_a_slice_of_train(featured):
    config = training.BoostedConfig(n_estimators=12, max_depth=2, validation_fraction=0.25, validation_tol=0.9)
    model = training.train_boosted(featured, config, key=["id"])
    assert all(m.getNumTrees < 12 for m in model.models)
    with pytest.raises(ValueError, match="row key"):
        training.train_boosted(featured, config)


def test_given_weights_change_the_model(spark, featured, logistic):
    heavy = spark.createDataFrame([(0.0, 50.0), (1.0, 1.0), (2.0, 1.0)], "label double, weight double")
    model = training.train_logistic(featured, training.LogisticConfig(max_iter=50), heavy)
    assert model.interceptVector[0] != pytest.approx(logistic.interceptVector[0])
    strong = training.aggressive_class_weights(featured)
    assert strong.agg(F.avg("weight")).first()[0] == pytest.approx(1)


def test_importances_and_coefficients(spark, fitted, boosted, logistic):
    importance = training.importance_frame(spark, boosted, fitted.feature_names)
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert training.feature_importance(spark, boosted, fitted.feature_names, 5).count() == 5
    top = training.coefficient_importance(spark, logistic, fitted.feature_names, fitted.class_names, 4)
    assert top.count() == 3 * 2 * 4
    best = top.where("class = 'space' and side = 'positive' and rank = 1").first()
    assert best.coefficient > 0


def test_cross_validation_and_choice(spark, featured, fitted, test, logistic):
    cv = selection.cross_validate(
        featured, lambda rows: training.train_logistic(rows, training.LogisticConfig(max_iter=20)), ["id"], folds=2
    )
    assert [r.fold for r in cv.orderBy("fold").collect()] == [0, 1]
    forest = training.train_forest(featured, training.ForestConfig(n_estimators=3, max_depth=2))
    held_out = fitted.transform(test)
    metrics = {
        "forest": overall_metrics(training.predict(forest, held_out)),
        "logistic": overall_metrics(training.predict(logistic, held_out)),
    }
    out = scratch_path(spark, "choice")
    table, best = selection.choose_model(metrics, f"{out}/comparison", f"{out}/best")
    assert best == "logistic" and table.count() == 2
    assert spark.read.option("header", True).csv(f"{out}/comparison").count() == 2
    record = selection.evaluation_record(training.predict(logistic, held_out), fitted.class_names, cv).first()
    assert set(record["per_class"]) == set(WORDS) and 0 <= record["cv_results"]["mean"] <= 1


def test_saved_classifier_scores_alike(spark, fitted, logistic, boosted):
    for model in (logistic, boosted):
        root = scratch_path(spark, "classifier")
        path = default_model_path(root, type(model).__name__)
        save_model(spark, model, path, n_features=71, class_names=fitted.class_names)
        fitted.save(spark, f"{root}/features")
        loaded, metadata = load_model(spark, path)
        assert isinstance(loaded, type(model)) and metadata["class_names"] == fitted.class_names
        one = Classifier.load(spark, path, f"{root}/features")
        args = ("Rocket Tales Book 2", "A rocket in orbit around a star", 9.99, 4.5, 100, "Paperback")
        got = one.predict(spark, *args)
        assert got == Classifier(fitted, model).predict(spark, *args)
        assert got["predicted_class"] == "space" and len(got["top_3"]) == 3
        assert got["confidence"] == got["top_3"][0]["probability"]
        assert sum(p["probability"] for p in got["top_3"]) == pytest.approx(1)
    assert isinstance(loaded, OneVsRestModel)


REQUESTS = [
    ("The Salt Kitchen", "A recipe with butter", 299.99, 4.5, 12, "Hardcover"),
    ("Crown", "king and empire", 0.99, 3.5, 234, "Kindle"),
    ("Short", "", 15.99, 4.0, 100, "Paperback"),
    (None, None, None, None, None, None),
    ("Comet #4", "<b>galaxy</b> http://x.y star", 1.0, 0.0, 3, "Scroll"),
]


@pytest.mark.parametrize("kind", ["logistic", "boosted"])
def test_stream_scores_like_batch(spark, fitted, request, kind):
    classifier = Classifier(fitted, request.getfixturevalue(kind))
    requests = spark.createDataFrame(REQUESTS, S.REQUEST_SCHEMA).repartition(3)
    source = scratch_path(spark, "requests")
    requests.write.parquet(source)
    output, checkpoint = scratch_path(spark, "answers"), scratch_path(spark, "state")
    for _ in range(2):  # a second run finds nothing new
        score_stream(classifier, request_stream(spark, source, S.REQUEST_SCHEMA), output, checkpoint).awaitTermination()
    columns = ["price_numeric", "predicted_class", "confidence", "top_3"]
    got = read_answers(spark, output).select(*columns).collect()
    want = classifier.score(requests).select(*columns).collect()
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == len(REQUESTS)


def test_every_request_keeps_one_answer(spark, fitted, logistic):
    """New checkpoints, new files and batches that never reached the manifest."""
    classifier = Classifier(fitted, logistic)
    source, output = scratch_path(spark, "requests"), scratch_path(spark, "answers")
    requests = spark.createDataFrame(REQUESTS, S.REQUEST_SCHEMA)
    requests.coalesce(1).write.parquet(source)
    stream = lambda: score_stream(classifier, request_stream(spark, source, S.REQUEST_SCHEMA), output, scratch_path(spark, "state")).awaitTermination()
    answers = lambda: sorted(map(tuple, read_answers(spark, output).select("price_numeric", "predicted_class", "confidence").collect()), key=str)
    stream()
    first = answers()
    stream()
    assert answers() == first and len(first) == len(REQUESTS)
    requests.limit(2).coalesce(1).write.mode("append").parquet(source)
    stream()
    assert len(answers()) == len(REQUESTS) + 2
    assert manifest(spark, output).select("file").distinct().count() == 2
    # A batch that wrote answers but no manifest entry does not count.
    classifier.score(requests).write.parquet(f"{output}/answers/run=lost/batch=0")
    assert len(answers()) == len(REQUESTS) + 2


def test_codes_of_many_values(spark):
    df = spark.range(3000).selectExpr("id", "concat('v', lpad(id * 7 % 1000, 4, '0')) AS format").repartition(5)
    df = df.unionByName(spark.createDataFrame([(9000, None)], "id long, format string"))
    codes = {r.value: r.code for r in dense_codes(df.repartition(4), "format").collect()}
    assert codes == {f"v{i:04d}": float(i) for i in range(1000)}
    got = {r.id: r.code_format for r in label_codes(df, ["format"]).collect()}
    assert len(got) == 3001 and all(got[i] == i * 7 % 1000 for i in range(3000)) and got[9000] == 0.0
    stage = CodedColumns.fitted(df, ["format"], ["c"], scratch_path(spark, "codes"))
    moved = stage.moved(spark, scratch_path(spark, "moved"))
    unseen = spark.createDataFrame([("v0005",), ("other",), (None,)], "format string")
    assert [r.c for r in moved.transform(unseen).collect()] == [5.0, 0.0, 0.0]


def test_request_defaults_are_training_medians(spark, fitted):
    requests = spark.createDataFrame([("t", "d")], "title string, description string")
    row = Classifier(fitted, None).request_frame(requests).first()
    assert row["price_numeric"] == fitted.medians["price_numeric"]
    row = Classifier(fitted, None, {"price_numeric": 1.5}).request_frame(requests).first()
    assert row["price_numeric"] == 1.5
