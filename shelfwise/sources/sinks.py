"""Writing tables, side tables and reports."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write in parallel as Parquet (default), CSV, JSON or ORC."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
        writer = writer.option("ignoreLeadingWhiteSpace", False)
        writer = writer.option("ignoreTrailingWhiteSpace", False)
    writer.format(fmt).save(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """Write a class-level or one-row table as JSON lines."""
    df.write.mode("overwrite").json(path)
    return path


def write_model_comparison(comparison: DataFrame, path: str) -> str:
    """Write the one-row-per-model table as one CSV file."""
    comparison.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_classification_report(report: DataFrame, path: str, title: str = "") -> str:
    """Write the per-class report (one row per class) as aligned text."""
    cells = [F.rpad(F.col("class"), 30, " ")]
    cells += [
        F.lpad(F.coalesce(F.format_number(c, 4), F.lit("")), 12, " ")
        for c in ("precision", "recall", "f1_score")
    ]
    cells.append(F.lpad(F.col("support").cast("string"), 12, " "))
    report.select(F.concat(F.lit(f"{title} " if title else ""), *cells).alias("value")).coalesce(
        1
    ).write.mode("overwrite").text(path)
    return path


def write_summary_report(sections: dict[str, DataFrame], path: str, parallelism: int = 4) -> dict[str, str]:
    """Write each section of the data report as JSON under its own name.

    The sections are independent small jobs, so several run at a time.
    """
    with ThreadPool(parallelism) as pool:
        written = pool.map(lambda name: write_json(sections[name], f"{path}/{name}"), sections)
    return dict(zip(sections, written))


def write_features(df: DataFrame, path: str) -> str:
    """Write feature vectors and labels, partitioned by split where present."""
    writer = df.write.mode("overwrite")
    if "split" in df.columns:
        writer = writer.partitionBy("split")
    writer.parquet(path)
    return path
