"""Reading tables and small side tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfwise import schemas as S
from shelfwise.functions.numeric import nan_to_null
from shelfwise.sources.quoted_csv import read_quoted_csv

FORMATS = {".parquet": "parquet", ".csv": "csv", ".json": "json", ".orc": "orc"}

# Texts that stand for a missing value in CSV files.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def format_of(path: str) -> str:
    """The format a path's suffix stands for; no suffix means Parquet."""
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    if "." not in name:
        return "parquet"
    suffix = name[name.rindex(".") :]
    if suffix not in FORMATS:
        raise ValueError(f"unsupported file format {suffix!r}; supported: {sorted(FORMATS)}")
    return FORMATS[suffix]


def _read_csv(spark: SparkSession, path: str, types: dict[str, T.DataType]) -> DataFrame:
    """Columns by header name, missing texts as null, known columns typed.

    A large file is read by many tasks, line breaks in quotes or not.
    """
    raw = read_quoted_csv(spark, path)

    def typed(name: str):
        value = F.when(~F.col(f"`{name}`").isin(MISSING_TEXTS), F.col(f"`{name}`"))
        kind = types.get(name, T.StringType())
        if isinstance(kind, (T.LongType, T.IntegerType)):
            # Whole numbers may be written with a decimal point.
            return value.try_cast("double").try_cast(kind)
        return value if isinstance(kind, T.StringType) else value.try_cast(kind)

    return raw.select(*[typed(c).alias(c) for c in raw.columns])


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    types: dict[str, T.DataType] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """A table in the format of its suffix, with NaN turned into null.

    A missing path raises Spark's ``PATH_NOT_FOUND``. ``rows`` is the reader's
    optional row limit.
    """
    fmt = fmt or format_of(path)
    if fmt == "csv":
        df = _read_csv(spark, path, types or {})
    else:
        df = spark.read.format(fmt).load(path)
    df = nan_to_null(df)
    return df if rows is None else df.limit(rows)


def read_catalogue(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    """The product catalogue."""
    return read_table(spark, path, types=S.CATALOGUE_TYPES, rows=rows)


def read_reviews(spark: SparkSession, path: str, rows: int | None = None) -> DataFrame:
    """The user reviews."""
    return read_table(spark, path, types=S.REVIEW_TYPES, rows=rows)


def read_optional_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A JSON side table, or None where the path does not exist."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
