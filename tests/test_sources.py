import pytest
from pyspark.errors import AnalysisException

from shelfwise.operators.profile import summary_sections
from shelfwise.plans import prepare as P
from shelfwise.plans.config import PrepareConfig, SplitConfig
from shelfwise.session import scratch_path, small_side, spread
from shelfwise.sources import sinks, tables


def test_csv_reader(spark, tmp_path):
    path = tmp_path / "books.csv"
    path.write_text(
        "parent_asin,title,description,price_numeric,rating_number,extra\n"
        'a1,"Quoted ""title"", x","two\nlines",12.5,7.0,NA\n'
        "a2,None,,bad,,kept\n"
        'a3,"  padded  ","",NaN,3,\n'
    )
    rows = {r.parent_asin: r for r in tables.read_catalogue(spark, str(path)).collect()}
    assert rows["a1"]["title"] == 'Quoted "title", x' and rows["a1"]["description"] == "two\nlines"
    assert rows["a1"]["price_numeric"] == 12.5 and rows["a1"]["rating_number"] == 7 and rows["a1"]["extra"] is None
    assert rows["a2"]["title"] is None and rows["a2"]["price_numeric"] is None and rows["a2"]["extra"] == "kept"
    assert rows["a3"]["title"] == "  padded  " and rows["a3"]["description"] is None
    assert rows["a3"]["price_numeric"] is None
    assert tables.read_catalogue(spark, str(path), rows=2).count() == 2


def test_review_types(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text("parent_asin,user_id,rating,text,verified_purchase,year\na,u,5.0,fine,True,2020\na,v,x,ok,,\n")
    rows = tables.read_reviews(spark, str(path)).collect()
    assert rows[0]["verified_purchase"] is True and rows[0]["year"] == 2020 and rows[1]["rating"] is None


def test_formats_and_missing_paths(spark):
    assert tables.format_of("/x/a.CSV") == "csv" and tables.format_of("/x/a") == "parquet"
    with pytest.raises(ValueError, match="unsupported"):
        tables.format_of("/x/a.pkl")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        tables.read_table(spark, "/nowhere/a.parquet")
    assert tables.read_optional_json(spark, "/nowhere/weights.json") is None


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc", "csv"])
def test_round_trips(spark, fmt):
    df = spark.createDataFrame([("a", "x, \"y\"\n z"), ("b", None)], "k string, t string")
    path = scratch_path(spark, "trip") + f".{fmt}"
    sinks.write_table(df, path, fmt)
    assert sorted(map(tuple, tables.read_table(spark, path).select("k", "t").collect())) == sorted(map(tuple, df.collect()))


def test_nan_is_null_on_ingest(spark):
    path = scratch_path(spark, "nan")
    spark.createDataFrame([(float("nan"),)], "x double").write.parquet(path)
    assert tables.read_table(spark, path).first().x is None


def test_small_side_is_bounded(spark):
    df = spark.range(10)
    assert small_side(df, 5) is df
    assert small_side(df, 10).count() == 10


def test_spread_leaves_large_scans_alone(spark):
    wide = spark.range(0, 100, 1, 64)
    assert spread(wide) is wide
    assert spread(spark.range(0, 100, 1, 2)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


CATALOGUE = "parent_asin string, title string, description string, category_level_2_sub string, price_numeric double"
REVIEWS = "parent_asin string, user_id string, rating double, text string, helpful_vote bigint, verified_purchase boolean, year int"


@pytest.fixture(scope="module")
def raw(spark):
    books = [(f"b{i}", f"Book {i} #7", None if i % 5 else f"About {i}", "AB"[i % 2], float(i)) for i in range(60)]
    reviews = [(f"b{i}", f"u{j}", float(j % 6), f"text {j}", j - 1, j % 2 == 0, 2000 + j) for i in range(50) for j in range(i % 7)]
    return spark.createDataFrame(books, CATALOGUE), spark.createDataFrame(reviews, REVIEWS)


def test_prepare_and_split(spark, raw):
    config = PrepareConfig(min_samples_per_category=10, sampling_fraction=0.5, min_reviews_per_book=1)
    stages = P.prepare(*raw, config)
    assert stages.enriched.count() == 60
    # The '#' is gone from the cleaned title; the flag was taken before.
    row = stages.enriched.first()
    assert "#" not in row["title"] and row["has_series"] == 1
    kept = stages.filtered.groupBy("category_level_2_sub").count().collect()
    assert stages.sampled.count() == sum(round(r["count"] * 0.5) for r in kept)
    path = scratch_path(spark, "sampled") + ".parquet"
    P.save_prepared(stages.sampled, path, weights=stages.weights, weights_path=path + ".weights")
    assert spark.read.json(path + ".weights").count() == 2
    result = P.run_split(spark, path, scratch_path(spark, "out"), SplitConfig())
    n = stages.sampled.count()
    assert result["train"].count() + result["test"].count() == n
    assert result["test"].count() == -(-n * 2 // 10)
    assert result["split_info"].first()["total_samples"] == n
    with pytest.raises(ValueError, match="target column"):
        P.load_prepared(spark, path, "nothing")


def test_undersample_strategy(raw):
    config = PrepareConfig(min_samples_per_category=1, balance_strategy="undersample", undersample_cap=7)
    counts = P.prepare(*raw, config).sampled.groupBy("category_level_2_sub").count().collect()
    assert [r["count"] for r in counts] == [7, 7]
    with pytest.raises(ValueError):
        PrepareConfig(balance_strategy="undersample")
    with pytest.raises(ValueError):
        PrepareConfig(balance_strategy="other")


def test_workflow_from_files_to_a_scoring_classifier(spark, raw):
    from shelfwise.plans.features import FeatureConfig
    from shelfwise.plans.scoring import Classifier
    from shelfwise.plans.training import BoostedConfig, LogisticConfig
    from shelfwise.plans.workflow import WorkflowConfig, run_workflow

    books = sinks.write_table(raw[0], scratch_path(spark, "in") + ".csv", "csv")
    reviews = sinks.write_table(raw[1], scratch_path(spark, "in") + ".parquet")
    config = WorkflowConfig(
        prepare=PrepareConfig(min_samples_per_category=5),
        features=FeatureConfig(max_features=20),
        boosted=BoostedConfig(n_estimators=2, max_depth=2),
        logistic=LogisticConfig(max_iter=5),
        aggressive=True,
    )
    output = scratch_path(spark, "workflow")
    done = run_workflow(spark, books, reviews, output, config)
    assert done["best"] in ("boosted", "logistic")
    assert spark.read.option("header", True).csv(f"{output}/comparison").count() == 2
    assert spark.read.json(f"{output}/models/logistic/metrics").first()["cv_results"]["mean"] >= 0
    one = Classifier.load(spark, done["model"], done["extractor"])
    assert one.predict(spark, "Book 4 #7", "About 4", 4.0, 4.0, 5, "Kindle")["predicted_class"] in "AB"
    with pytest.raises(ValueError, match="required columns"):
        run_workflow(spark, reviews, reviews, output, config)


def test_scratch_folder_choice(spark):
    from types import SimpleNamespace

    from shelfwise.session import scratch_root

    def session(master, folder=None):
        conf = SimpleNamespace(get=lambda key, default: folder or default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))

    assert scratch_root(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert scratch_root(session("yarn")) is None
    assert scratch_root(session("local[2]")) == scratch_root(session("local[2]")) is not None
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("yarn"), "x")


def test_summary_report(spark, raw):
    paths = sinks.write_summary_report(summary_sections(spark, *raw), scratch_path(spark, "report"))
    assert {"basic_info", "missing_values", "ratings", "reviews_per_book", "years", "verified_purchase"} <= set(paths)
    assert spark.read.json(paths["basic_info"]).first()["total_rows"] == 60


def test_text_report(spark):
    from shelfwise.operators.evaluation import classification_report

    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    path = sinks.write_classification_report(classification_report(df), scratch_path(spark, "text"))
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 5 and any("weighted avg" in line for line in lines)
