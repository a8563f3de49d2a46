"""Feature extraction: fit on the training split, transform any frame.

The fitted object is a saved-and-loadable ``PipelineModel`` of sparse vectors;
nothing is made dense. Blocks are assembled in the order text, numerical,
categorical, engineered.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    OneHotEncoder,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise import schemas as S
from shelfwise.operators.quantiles import exact_quantiles
from shelfwise.operators.sampling import split_distribution
from shelfwise.operators.tfidf import TOKEN_PATTERN, TermConfig, vocabulary
from shelfwise.plans.stages import (
    BLOCKS,
    CATEGORY_COLS,
    ENGINEERED_COLS,
    NUMBER,
    SCALED,
    CodedColumns,
    FeatureColumns,
    StandardizeColumns,
    UnseenToFirst,
    moments,
)
from shelfwise.session import cut_lineage, scratch_path
from shelfwise.sources.models import load_metadata, save_metadata
from shelfwise.sources.sinks import write_features, write_json


@dataclass(frozen=True)
class FeatureConfig:
    """Vocabulary limits, inputs and encodings.

    ``stop_words`` None takes Spark's English list. ``encoding`` is ``ordinal``
    or ``onehot``. ``handle_invalid`` decides on rows whose target is unknown:
    ``skip`` drops them, ``first`` gives them class 0.
    """

    max_features: int
    ngram_range: tuple[int, int] = (1, 2)
    min_df: int = 2
    max_df: float = 0.95
    stop_words: tuple[str, ...] | None = None
    numeric: tuple[str, ...] = tuple(S.NUMERIC_FEATURES)
    encoding: str = "ordinal"
    handle_invalid: str = "skip"
    target: str = S.TARGET
    label: str = "label"

    def __post_init__(self):
        if self.encoding not in ("ordinal", "onehot"):
            raise ValueError(f"unknown encoding: {self.encoding!r}")
        if self.handle_invalid not in ("skip", "first"):
            raise ValueError(f"unknown handle_invalid: {self.handle_invalid!r}")


@dataclass
class FittedFeatures:
    """Fitted stages, the target index and the name of every feature."""

    config: FeatureConfig
    stages: PipelineModel
    target: StringIndexerModel
    names: dict[str, list[str]]
    medians: dict[str, float] = field(default_factory=dict)

    @property
    def class_names(self) -> list[str]:
        return list(self.target.labels)

    @property
    def feature_names(self) -> list[str]:
        return [name for block in BLOCKS for name in self.names[block]]

    def transform_inference(self, df: DataFrame) -> DataFrame:
        """Adds ``features``; no target needed. Works on streams too."""
        out = self.stages.transform(df)
        return out.select(*df.columns, "features")

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``features`` and the label index."""
        if self.config.target not in df.columns:
            raise ValueError(f"target column {self.config.target!r} not found; columns: {df.columns}")
        keep = self.config.handle_invalid == "first"
        indexer = self.target.copy().setHandleInvalid("keep" if keep else "skip")
        labelled = indexer.transform(df)
        if keep:
            labelled = UnseenToFirst(cols=[self.config.label], sizes=[len(self.class_names)]).transform(labelled)
        return self.transform_inference(labelled)

    def stats(self) -> dict:
        """Feature counts per block, classes and settings."""
        return {
            "status": "fitted",
            "total_features": len(self.feature_names),
            "feature_breakdown": {b: len(self.names[b]) for b in BLOCKS},
            "target_info": {"n_classes": len(self.class_names), "classes": self.class_names},
            "config": asdict(self.config),
            "feature_names": self.names,
        }

    def feature_table(self, spark: SparkSession) -> DataFrame:
        """(idx, name, block, term) of every feature, at most a few thousand rows."""
        terms = next(s for s in self.stages.stages if isinstance(s, CountVectorizerModel)).vocabulary
        rows, idx = [], 0
        for block in BLOCKS:
            for i, name in enumerate(self.names[block]):
                rows.append((idx, name, block, terms[i] if block == "text" else None))
                idx += 1
        return spark.createDataFrame(rows, "idx int, name string, block string, term string")

    def block_of(self, name: str) -> str:
        """The block a feature name belongs to."""
        return next((b for b in BLOCKS if name in self.names[b]), "unknown")

    def save(self, spark: SparkSession, path: str) -> None:
        """Save stages, target index and metadata under one folder."""
        stages = [s.moved(spark, f"{path}/codes") if isinstance(s, CodedColumns) else s for s in self.stages.stages]
        PipelineModel(stages).write().overwrite().save(f"{path}/stages")
        self.target.write().overwrite().save(f"{path}/target")
        metadata = {
            "config": asdict(self.config),
            "feature_names": self.names,
            "target_classes": self.class_names,
            "n_classes": len(self.class_names),
            "medians": self.medians,
        }
        save_metadata(spark, metadata, f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedFeatures:
        """Load what ``save`` wrote; a missing folder raises FileNotFoundError."""
        metadata = load_metadata(spark, f"{path}/metadata")
        settings = {k: tuple(v) if isinstance(v, list) else v for k, v in metadata["config"].items()}
        return cls(
            FeatureConfig(**settings),
            PipelineModel.load(f"{path}/stages"),
            StringIndexerModel.load(f"{path}/target"),
            metadata["feature_names"],
            metadata["medians"],
        )


def _term_stages(config: FeatureConfig) -> tuple[list, TermConfig]:
    stop_words = config.stop_words
    if stop_words is None:
        stop_words = tuple(StopWordsRemover.loadDefaultStopWords("english"))
    low, high = config.ngram_range
    stages = [
        RegexTokenizer(inputCol="_text", outputCol="_tokens", pattern=TOKEN_PATTERN, gaps=False),
        StopWordsRemover(inputCol="_tokens", outputCol="_words", stopWords=list(stop_words)),
    ]
    stages += [NGram(n=n, inputCol="_words", outputCol=f"_run{n}") for n in range(low, high + 1)]
    runs = ", ".join(f"_run{n}" for n in range(low, high + 1))
    stages.append(SQLTransformer(statement=f"SELECT *, concat({runs}) AS _terms FROM __THIS__"))
    limits = TermConfig(config.max_features, config.ngram_range, config.min_df, config.max_df)
    return stages, limits


def fit_features(df: DataFrame, config: FeatureConfig) -> FittedFeatures:
    """Fit every transformer on the training frame.

    Driver data is bounded: the vocabulary by ``max_features``, the rest by the
    number of columns and classes.
    """
    if config.target not in df.columns:
        raise ValueError(f"target column {config.target!r} not found; columns: {df.columns}")
    numeric = [c for c in config.numeric if c in df.columns]
    columns = FeatureColumns(numericCols=numeric)
    term_stages, limits = _term_stages(config)
    prepared = columns.transform(df)
    target = StringIndexer(
        inputCol=config.target, outputCol=config.label, stringOrderType="alphabetAsc", handleInvalid="skip"
    ).fit(df.where(F.col(config.target).isNotNull()))
    if not target.labels:
        raise ValueError("the training frame has no labelled rows")

    tokens = PipelineModel(term_stages).transform(prepared.select("_text"))
    kept = sorted(vocabulary(tokens, "_terms", limits).select("term", "idf").collect())
    if not kept:
        raise ValueError("no term satisfies the document-frequency limits")
    stages = [
        columns,
        *term_stages,
        CountVectorizerModel.from_vocabulary([r.term for r in kept], inputCol="_terms", outputCol="_counts"),
        ElementwiseProduct(
            scalingVec=Vectors.dense([r.idf for r in kept]), inputCol="_counts", outputCol="_weighted"
        ),
        Normalizer(p=2.0, inputCol="_weighted", outputCol="_tfidf"),
    ]
    names = {"text": [f"tfidf_{i}" for i in range(len(kept))], "numerical": numeric}
    blocks = ["_tfidf"]

    if numeric:
        inputs, outputs = [f"{NUMBER}{c}" for c in numeric], [f"{SCALED}{c}" for c in numeric]
        means, deviations = moments(prepared, inputs)
        stages.append(
            StandardizeColumns(inputCols=inputs, outputCols=outputs, means=means, deviations=deviations)
        )
        blocks += outputs

    codes = [f"{c}_idx" for c in CATEGORY_COLS]
    names["categorical"] = list(S.CATEGORICAL_FEATURES)
    if config.encoding == "onehot":
        # A feature for each value: the values are few by this choice.
        encoder = StringIndexer(
            inputCols=CATEGORY_COLS, outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep"
        ).fit(prepared)
        stages += [encoder, UnseenToFirst(cols=codes, sizes=[len(labels) for labels in encoder.labelsArray])]
        hot = [f"{c}_hot" for c in CATEGORY_COLS]
        one_hot = OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=False)
        indexed = PipelineModel(stages[-2:]).transform(prepared.select(*CATEGORY_COLS))
        fitted = one_hot.fit(indexed)
        stages.append(fitted)
        blocks += hot
        names["categorical"] = [
            f"{c}={value}"
            for c, labels, n in zip(S.CATEGORICAL_FEATURES, encoder.labelsArray, fitted.categorySizes)
            for value in list(labels)[:n]
        ]
    else:
        stages.append(CodedColumns.fitted(prepared, CATEGORY_COLS, codes, scratch_path(df.sparkSession, "codes")))
        blocks += codes
    names["engineered"] = list(S.ENGINEERED_FEATURES)
    stages.append(VectorAssembler(inputCols=blocks + ENGINEERED_COLS, outputCol="features"))
    return FittedFeatures(config, PipelineModel(stages), target, names, _medians(prepared, numeric))


def _medians(prepared: DataFrame, numeric: list[str]) -> dict[str, float]:
    """Training medians: what scoring fills in for inputs a request lacks."""
    if not numeric:
        return {}
    values = prepared.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{NUMBER}{c}").alias("value")) for c in numeric])
        ).alias("_r")
    ).select("_r.*")
    rows = exact_quantiles(values, ["column"], "value", {"median": 0.5}, True).collect()
    return {r["column"]: r["median"] for r in rows}


def class_info(featured: DataFrame, class_names: list[str], label: str = "label") -> DataFrame:
    """Index, name and rows per split of every class."""
    spark = featured.sparkSession
    classes = spark.createDataFrame(list(enumerate(class_names)), "idx int, class string")
    counts = featured.groupBy(F.col(label).cast("int").alias("idx")).agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
    )
    return classes.join(counts, "idx", "left").fillna(0, ["train_rows", "test_rows"])


def dataset_summary(featured: DataFrame, fitted: FittedFeatures) -> DataFrame:
    """Rows per split, test share, feature counts and classes, as one row."""
    breakdown = [F.lit(len(fitted.names[b])).alias(f"{b}_features") for b in BLOCKS]
    return featured.agg(
        F.count_if(F.col("split") == "train").alias("train_samples"),
        F.count_if(F.col("split") == "test").alias("test_samples"),
        F.count(F.lit(1)).alias("total_samples"),
        (F.count_if(F.col("split") == "test") / F.count(F.lit(1))).alias("test_split_ratio"),
    ).select(
        "*",
        F.lit(len(fitted.feature_names)).alias("total_features"),
        *breakdown,
        F.lit(len(fitted.class_names)).alias("n_classes"),
        F.array(*[F.lit(c) for c in fitted.class_names]).alias("class_names"),
    )


def save_features_and_metadata(
    split: DataFrame, fitted: FittedFeatures, output_dir: str, model_dir: str, keep: list[str] | None = None
) -> dict[str, str]:
    """Write features, names, classes, summary and the fitted stages.

    ``split`` carries the ``split`` column; features are computed once. Columns
    in ``keep``, such as the row key, are written along.
    """
    spark = split.sparkSession
    paths = {
        name: f"{output_dir}/{name}" for name in ("features", "feature_names", "class_info", "distribution", "summary")
    }
    label = fitted.config.label
    write_features(fitted.transform(split).select("split", *(keep or []), label, "features"), paths["features"])
    featured = spark.read.parquet(paths["features"])
    write_json(fitted.feature_table(spark), paths["feature_names"])
    write_json(class_info(featured, fitted.class_names, label), paths["class_info"])
    write_json(split_distribution(featured, label), paths["distribution"])
    write_json(dataset_summary(featured, fitted), paths["summary"])
    fitted.save(spark, model_dir)
    return paths | {"model": model_dir}


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """Read written feature vectors and labels."""
    return spark.read.parquet(path)


def featured_once(fitted: FittedFeatures, df: DataFrame) -> DataFrame:
    """Features written once for the passes of a training job."""
    return cut_lineage(fitted.transform(df), "features")
