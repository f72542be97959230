"""Running values over documents of any length.

A window over a document puts the document into one task. These helpers cut its rows into
blocks of consecutive positions, run the window inside each block, and carry one row per block
over the blocks, so the rows of the largest document are spread like any others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docstrata.runtime import checkpoint

BLOCK = 4096


def _block(order: Column) -> Column:
    return F.floor(F.coalesce(order, F.lit(-1)) / BLOCK)


def with_ordinal(df: DataFrame, keys: list[str], order: str, ties: list[str], name: str) -> DataFrame:
    """Adds the 1-based rank of each row among the rows of equal keys, by order and ties. Numbers are positions and
    cut by their size; rows ordered by a string are dealt to ranges of keys and order, which split a key that holds many
    rows, and the ranges are the blocks."""
    if dict(df.dtypes)[order] == "string":
        cut = checkpoint(df.repartitionByRange(*keys, order).withColumn("_b", F.spark_partition_id()))
    else:
        cut = df.withColumn("_b", _block(F.col(order)))
    inside = cut.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(order, *ties)))
    sizes = cut.groupBy(*keys, "_b").agg(F.count("*").alias("_size"))
    w = Window.partitionBy(*keys).orderBy("_b")
    before = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_kb"), (F.sum("_size").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")).alias("_before"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = inside.join(before, [*same, F.col("_b") == F.col("_kb")])
    return joined.withColumn(name, (F.col("_n") + F.col("_before")).cast("bigint")).drop("_b", "_n", "_before", "_kb", *[f"_k{i}" for i in range(len(keys))])


def with_running_max(df: DataFrame, key: str, order: str, values: dict[str, Column]) -> DataFrame:
    """Adds, for each name, the maximum of its expression over the earlier rows of the key
    (null without one)."""
    cut = df.select("*", *[v.alias(f"_v_{k}") for k, v in values.items()]).withColumn("_b", _block(F.col(order)))
    w = Window.partitionBy(key, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = cut.select("*", *[F.max(f"_v_{k}").over(w).alias(f"_i_{k}") for k in values])
    tops = cut.groupBy(key, "_b").agg(*[F.max(f"_v_{k}").alias(f"_t_{k}") for k in values])
    over = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(F.col(key).alias("_k"), F.col("_b").alias("_kb"), *[F.max(f"_t_{k}").over(over).alias(f"_c_{k}") for k in values])
    joined = inside.join(carried, (F.col(key) == F.col("_k")) & (F.col("_b") == F.col("_kb")))
    out = joined.select("*", *[F.coalesce(f"_i_{k}", f"_c_{k}").alias(k) for k in values])  # what lies in the block is later
    return out.drop("_b", "_k", "_kb", *[f"_{p}_{k}" for p in "vitc" for k in values])
