"""Incremental runs over an inbox of delivered elements (an extension of the batch pipeline)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def elements_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """New element files as a stream; run() takes redelivered rows out."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(path)


def run(stream: DataFrame, batch: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Apply a batch operator to each micro-batch; the batch's number is part of the path, so a batch
    that is run again overwrites itself. A redelivered row (same id) comes once, however late; the
    ids of each batch are kept beside the checkpoint. Rows without an id all come."""
    seen = f"{checkpoint.rstrip('/')}-ids"

    def write(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        known = df.where("id IS NOT NULL").dropDuplicates(["id"])
        if number:
            before = spark.read.schema(f"id {df.schema['id'].dataType.simpleString()}, batch bigint").parquet(seen)
            known = known.join(before.where(F.col("batch") < number), "id", "left_anti").select(df.columns)
        known.select("id").write.mode("overwrite").parquet(f"{seen}/batch={number}")
        batch(known.unionAll(df.where("id IS NULL"))).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
