"""Stateless streaming job that scores request files as they arrive, each once.

A micro-batch writes its answers to a folder of its own and then a manifest entry
with the files it read; readers go by the manifest. A batch replayed after a
failure replaces its own folder and entry. A new checkpoint on old output is a new
run: it passes over files that an earlier run has answered, so every request keeps
one answer.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise.plans.scoring import Classifier

SOURCE = "_source"
MANIFEST = "run string, batch bigint, file string"


def request_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files: int = 1000,
) -> DataFrame:
    """A file stream with an explicit schema and bounded micro-batches; ``_source`` names a row's file."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.format(fmt).load(path).select("*", F.col("_metadata.file_path").alias(SOURCE))


def score_stream(
    classifier: Classifier,
    requests: DataFrame,
    output: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Score every request once and append the answers as Parquet.

    ``requests`` keep the column ``_source`` of ``request_stream``; without it a
    new run answers everything again. ``checkpoint`` and ``output`` belong on
    shared storage. ``read_answers`` reads what has been committed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = _run_of(spark, checkpoint)
        known = SOURCE in batch.columns
        if known:
            earlier = manifest(spark, output).where(F.col("run") != run).select(F.col("file").alias(SOURCE)).distinct()
            batch = batch.join(earlier, SOURCE, "left_anti")
            files = batch.select(F.col(SOURCE).alias("file")).distinct()
            batch = batch.drop(SOURCE)
        else:
            files = spark.createDataFrame([(None,)], "file string")
        classifier.score(batch).write.mode("overwrite").parquet(f"{output}/answers/run={run}/batch={batch_id}")
        # The batch counts from here on.
        entry = files.select(F.lit(run).alias("run"), F.lit(batch_id).cast("bigint").alias("batch"), "file")
        entry.write.mode("overwrite").parquet(f"{output}/manifest/{run}-{batch_id}")

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query of this checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first().value)["id"]


def manifest(spark: SparkSession, output: str) -> DataFrame:
    """``(run, batch, file)`` of all committed batches."""
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).parquet(f"{output}/manifest")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], MANIFEST)
        raise


def read_answers(spark: SparkSession, output: str) -> DataFrame:
    """The answers of committed batches."""
    done = manifest(spark, output).select("run", "batch").distinct()
    answers = spark.read.option("basePath", f"{output}/answers").parquet(f"{output}/answers/*/*")
    keyed = answers.withColumn("run", F.col("run").cast("string")).withColumn("batch", F.col("batch").cast("bigint"))
    return keyed.join(F.broadcast(done), ["run", "batch"], "left_semi").drop("run", "batch")
