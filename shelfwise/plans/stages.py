"""Pipeline stages that Spark ML lacks; each saves and loads with its parameters."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from shelfwise import schemas as S
from shelfwise.functions.numeric import (
    PRICE_BINS,
    RATING_BINS,
    binned,
    coerce_number,
    engagement,
    finite_ratio,
)
from shelfwise.functions.text import combined_text, has_series, text_length
from shelfwise.session import cut_lineage, small_side

NUMBER, SCALED, CODE, ENGINEERED = "num_", "std_", "cat_", "eng_"


def _column(df: DataFrame, name: str, default):
    return F.col(name) if name in df.columns else default


def _price(df: DataFrame):
    for name in ("price_numeric", "price"):
        if name in df.columns:
            return F.col(name)
    return F.lit(None).cast("double")


def numeric_block(df: DataFrame, columns: list[str], prefix: str = NUMBER) -> DataFrame:
    """Numeric inputs as doubles; bad, missing and absent values are 0."""
    return df.withColumns(
        {f"{prefix}{c}": coerce_number(_column(df, c, F.lit(None).cast("double"))) for c in columns}
    )


def categorical_block(df: DataFrame, prefix: str = CODE) -> DataFrame:
    """Book format, rating band and price band."""
    none = F.lit(None).cast("double")
    return df.withColumns(
        {
            f"{prefix}format": F.coalesce(_column(df, "format", F.lit(None).cast("string")), F.lit("Unknown")),
            f"{prefix}binned_rating": binned(_column(df, "average_rating", none), RATING_BINS),
            f"{prefix}price_category": binned(_price(df), PRICE_BINS),
        }
    )


def engineered_block(df: DataFrame, prefix: str = ENGINEERED) -> DataFrame:
    """Lengths, series flag, price per rating point and engagement."""
    none, empty = F.lit(None).cast("double"), F.lit(None).cast("string")
    title, rating = _column(df, "title", empty), _column(df, "average_rating", none)
    series = F.col("has_series") if "has_series" in df.columns else has_series(title)
    return df.withColumns(
        {
            f"{prefix}title_length": text_length(title).cast("double"),
            f"{prefix}desc_length": text_length(_column(df, "description", empty)).cast("double"),
            f"{prefix}has_series": F.coalesce(series, F.lit(0)).cast("double"),
            f"{prefix}price_rating_ratio": finite_ratio(_price(df), rating),
            f"{prefix}engagement_score": engagement(_column(df, "review_count", none), rating),
        }
    )


class FeatureColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Text, numeric, categorical and engineered inputs as plain columns."""

    numericCols = Param(Params._dummy(), "numericCols", "numeric inputs", TypeConverters.toListString)
    textCol = Param(Params._dummy(), "textCol", "combined text output", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, textCol="_text"):
        super().__init__()
        self._setDefault(numericCols=[], textCol="_text")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        empty = F.lit(None).cast("string")
        text = combined_text(_column(df, "title", empty), _column(df, "description", empty))
        out = df.withColumn(self.getOrDefault(self.textCol), text)
        return engineered_block(categorical_block(numeric_block(out, self.getOrDefault(self.numericCols))))


class StandardizeColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``(x - mean) / deviation`` with the fitted population moments."""

    inputCols = Param(Params._dummy(), "inputCols", "inputs", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "outputs", TypeConverters.toListString)
    means = Param(Params._dummy(), "means", "fitted means", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "fitted deviations", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, means=None, deviations=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = zip(
            self.getOrDefault(self.inputCols),
            self.getOrDefault(self.outputCols),
            self.getOrDefault(self.means),
            self.getOrDefault(self.deviations),
        )
        return df.withColumns({out: (F.col(c) - mean) / sd for c, out, mean, sd in fitted})


class UnseenToFirst(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The extra index a kept unseen value got becomes class 0."""

    cols = Param(Params._dummy(), "cols", "index columns", TypeConverters.toListString)
    sizes = Param(Params._dummy(), "sizes", "known values per column", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, cols=None, sizes=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        pairs = zip(self.getOrDefault(self.cols), self.getOrDefault(self.sizes))
        return df.withColumns({c: F.when(F.col(c) >= n, 0.0).otherwise(F.col(c)) for c, n in pairs})


def moments(df: DataFrame, columns: list[str]) -> tuple[list[float], list[float]]:
    """Mean and population deviation of each column in one aggregate; a constant has deviation 1."""
    if not columns:
        return [], []
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    n = len(columns)
    return [row[i] or 0.0 for i in range(n)], [row[n + i] or 1.0 for i in range(n)]


def standardized(df: DataFrame, columns: list[str], prefix: str = SCALED) -> DataFrame:
    """Fit and apply the standardisation of plain columns."""
    means, deviations = moments(df, columns)
    return StandardizeColumns(
        inputCols=columns, outputCols=[f"{prefix}{c}" for c in columns], means=means, deviations=deviations
    ).transform(df)


def dense_codes(df: DataFrame, column: str) -> DataFrame:
    """``(value, code)``: the rank of each distinct value in order, from 0.

    Values are dealt out by range; a value's rank is its place in its part plus
    the sizes of the parts before, so no task and not the driver sees all values.
    """
    values = df.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct()
    dealt = cut_lineage(values.repartitionByRange("value").withColumn("_part", F.spark_partition_id()), "codes")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # One row for each part.
    parts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(W.partitionBy("_part").orderBy("value")) - 1
    ranked = dealt.withColumn("_place", place).join(F.broadcast(starts), "_part")
    return ranked.select("value", (F.col("_start") + F.col("_place")).cast("double").alias("code"))


def with_codes(df: DataFrame, codes: DataFrame, column: str, output: str) -> DataFrame:
    """Adds the code of a column's value; missing and unknown values are 0."""
    named = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    joined = df.join(small_side(named), df[column].cast("string") == F.col("_value"), "left")
    return joined.withColumn(output, F.coalesce("_code", F.lit(0.0))).drop("_value", "_code")


def label_codes(df: DataFrame, columns: list[str], prefix: str = "code_") -> DataFrame:
    """Index of each value in the sorted list of values of its column."""
    for c in columns:
        df = with_codes(df, cut_lineage(dense_codes(df, c), "codes"), c, f"{prefix}{c}")
    return df


class CodedColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Columns as the codes of tables at ``path``, one folder a column; unknown values are 0."""

    inputCols = Param(Params._dummy(), "inputCols", "inputs", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "outputs", TypeConverters.toListString)
    path = Param(Params._dummy(), "path", "folder of the code tables", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, path=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def fitted(cls, df: DataFrame, columns: list[str], outputs: list[str], path: str) -> CodedColumns:
        for c in columns:
            dense_codes(df, c).write.mode("overwrite").parquet(f"{path}/{c}")
        return cls(inputCols=columns, outputCols=outputs, path=path)

    def table(self, spark: SparkSession, column: str) -> DataFrame:
        return spark.read.schema("value string, code double").parquet(f"{self.getOrDefault(self.path)}/{column}")

    def moved(self, spark: SparkSession, path: str) -> CodedColumns:
        """The same stage on a copy of its tables under ``path``."""
        for c in self.getOrDefault(self.inputCols):
            self.table(spark, c).write.mode("overwrite").parquet(f"{path}/{c}")
        return type(self)(inputCols=self.getOrDefault(self.inputCols), outputCols=self.getOrDefault(self.outputCols), path=path)

    def _transform(self, df: DataFrame) -> DataFrame:
        for c, output in zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.outputCols)):
            df = with_codes(df, self.table(df.sparkSession, c), c, output)
        return df


BLOCKS = ("text", "numerical", "categorical", "engineered")
ENGINEERED_COLS = [f"{ENGINEERED}{c}" for c in S.ENGINEERED_FEATURES]
CATEGORY_COLS = [f"{CODE}{c}" for c in S.CATEGORICAL_FEATURES]
