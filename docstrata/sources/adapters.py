"""From stored tables to the raw contracts of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.operators.scans import with_ordinal
from docstrata.operators.shred import latest
from docstrata.runtime import checkpoint, table


def single(elements: DataFrame) -> DataFrame:
    """Each element id once: the latest delivery."""
    rest = [c for c in elements.columns if c not in ("id", "loaded_at")]
    return elements.where(F.col("id").isNotNull()).groupBy("id").agg(F.max(F.struct("loaded_at", *rest)).alias("r")).select("id", *[F.col(f"r.{c}").alias(c) for c in rest])


def raw_items(spark: SparkSession, d: str, ordered: bool = True) -> DataFrame:
    """Page items of canonical_elements in reading order (schema.RAW_ITEM). ordered: whether they get positions, which
    counts over all items don't need."""
    e = single(table(spark, d, "canonical_elements").select("id", "document_id", "reading_order", "text", "heading_level", "provenance", "metadata", "loaded_at"))
    placed = with_ordinal(checkpoint(e), ["document_id"], "reading_order", ["id"], "n") if ordered else e.withColumn("n", F.lit(None).cast("bigint"))
    return placed.select(F.col("document_id").alias("doc_key"), (F.col("n") - 1).alias("pos"), F.col("metadata.docling_label").alias("label"), "text", F.col("heading_level").alias("level"), F.col("metadata.traversal_level").alias("traversal_level"), F.col("provenance").alias("prov"))


def delivered(spark: SparkSession, d: str) -> DataFrame:
    """canonical_elements as delivered, repeated rows included, with their list position."""
    e = table(spark, d, "canonical_elements").withColumn("at", F.coalesce(F.col("loaded_at").cast("timestamp"), F.lit("1900-01-01 00:00:00").cast("timestamp")))
    narrow = e.select("document_id", "id", "type", "text", "reading_order", "parent_id", "heading_level", "provenance", "at")
    return checkpoint(with_ordinal(narrow, ["document_id"], "reading_order", ["id", "at"], "n").withColumn("pos", F.col("n") - 1).drop("n", "at"))


def page_counts(spark: SparkSession, d: str) -> DataFrame:
    """document_id, page_count of the latest delivery of every document."""
    docs = latest(table(spark, d, "canonical_documents").select("id", "page_count", "delivered_at"), "id", "delivered_at")
    return docs.select(F.col("id").alias("document_id"), "page_count")


def latest_tables(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "extracted_tables").select("id", "document_id", "page", "method", "cells", "num_rows", "num_columns", "delivered_at"), "id", "delivered_at")


def raw_pictures(spark: SparkSession, d: str) -> DataFrame:
    """image_assets once each, in order of id, as pictures of their document."""
    a = table(spark, d, "image_assets").where(F.col("id").isNotNull())
    rest = ["document_id", "page", "kind", "complexity", "classification_confidence", "image_path", "caption", "ocr_text", "image_hash"]
    one = a.groupBy("id").agg(F.max(F.struct("loaded_at", *rest)).alias("r")).select("id", *[F.col(f"r.{c}").alias(c) for c in rest])
    return one.select(F.col("document_id").alias("doc_key"), F.col("id").alias("pos"), "page", "kind", "complexity", "classification_confidence", "image_path", "caption", "ocr_text", F.lower("image_hash").alias("image_hash"))
