"""The whole document pipeline over a corpus: raw items to elements, chunks, checks and report."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.config import Config
from docstrata.functions import scalars as S
from docstrata.operators import elements as E
from docstrata.operators import images, qa, tables
from docstrata.runtime import checkpoint
from docstrata.sources import export, readers


@dataclass
class Result:
    elements: DataFrame
    children: DataFrame
    roots: DataFrame
    chunks: DataFrame
    findings: DataFrame
    report: DataFrame
    manifest: DataFrame


def run(raw_docs: DataFrame, raw_items: DataFrame, config: Config | None = None, found: DataFrame | None = None, pictures: DataFrame | None = None) -> Result:
    """raw_docs: doc_key, source_name, content_sha256, page_count. found: tables with document_id; pictures: rows
    of images.deduplicated() with a caption; both only count in the report."""
    config = config or Config()
    done = checkpoint(E.normalize(raw_items, config.repeated_text_min_pages))
    documents = raw_docs.select(F.col("doc_key").alias("document_id"), "page_count")
    listed = done.withColumn("reading_order", F.col("pos"))
    report = qa.report(listed, documents, config.qa)
    if found is not None:
        n = found.groupBy("document_id").agg(F.count("*").alias("extracted_table_files"))
        report = report.join(n, "document_id", "left").withColumn("extracted_table_files", F.coalesce("extracted_table_files", F.lit(0)))
    if pictures is not None:
        n = images.hash_summary(pictures).join(pictures.where(~F.col("is_duplicate") & (F.length("caption") > 0)).groupBy("doc_key").agg(F.count("*").alias("captioned_images")), "doc_key", "left")
        n = n.select(F.col("doc_key").alias("document_id"), F.col("total_occurrences").alias("extracted_image_files"), F.col("unique_images").alias("unique_image_files"), F.col("duplicate_occurrences").alias("duplicate_image_occurrences"), "captioned_images")
        report = report.join(n, "document_id", "left").fillna(0, ["extracted_image_files", "unique_image_files", "duplicate_image_occurrences", "captioned_images"])
    manifest = raw_docs.join(report.select(F.col("document_id").alias("doc_key"), "passed"), "doc_key", "left").select("doc_key", "source_name", "content_sha256", F.when(F.col("passed"), "passed").otherwise("failed").alias("status"))
    return Result(done, E.children(done), E.roots(done), E.chunks(done), qa.findings(listed, documents, config.qa), report, manifest)


def evaluate(documents: DataFrame, config: Config | None = None, boxes: str = "fail") -> DataFrame:
    """The report of stored documents (schema.DOCUMENT). boxes: what an invalid box does, as in elements.checked_boxes()."""
    config = config or Config()
    at = documents.select(F.col("id").alias("document_id"), F.posexplode("elements").alias("pos", "e")).where(F.col("e").isNotNull())
    rows = at.select("document_id", F.col("pos").cast("bigint").alias("pos"), "e.id", "e.type", "e.text", "e.reading_order", "e.parent_id", "e.heading_level", "e.provenance")
    return qa.report(checkpoint(E.checked_boxes(rows, boxes)), documents.select(F.col("id").alias("document_id"), "page_count"), config.qa)


def run_sources(spark: SparkSession, path: str, converter: Callable[..., dict | list], output: str, config: Config | None = None, caption: Callable[[str, str], str] | None = None) -> tuple[Result, list[str]]:
    """Convert source files, run everything on them and write the artifacts of each document below output. Returns the
    result and the folders. Files that fail have a manifest and no elements. caption: the hook of images.captioned()."""
    config = config or Config()
    made = checkpoint(readers.convert(spark, path, converter, config))
    docs = made.select("doc_key", F.element_at(F.split("source", "/"), -1).alias("source_name"), "content_sha256", "page_count").dropDuplicates(["doc_key"])
    one = made.dropDuplicates(["doc_key"])
    found = checkpoint(tables.extract(readers.raw_tables(one), config.tables.mode))
    pictures = images.described(images.occurrences(readers.raw_pictures(one)))
    prompt = S.caption_prompt(F.col("page"), F.lit(None).cast("string"), F.col("kind"), F.col("ocr_text"))
    hashed = pictures.withColumn("image_path", F.concat(F.lit(f"{output}/"), "doc_key", F.lit("/images/"), "doc_key", F.lit("_img_"), F.left("image_hash", F.lit(12)), F.lit("_"), "complexity", F.lit(".png")))
    pictures = checkpoint(images.captioned(hashed.withColumn("prompt", prompt).withColumn("caption", F.lit(None).cast("string")), caption if config.captions.enabled else None, tuple(config.captions.skip_kinds)))
    result = run(docs, readers.raw_items(one), config, found, pictures)
    stored = docs.select(F.col("doc_key").alias("id"), "source_name", F.col("content_sha256").alias("source_sha256"), "page_count")
    folders = []
    for row in one.drop("items", "tables", "pictures").toLocalIterator():  # artifacts for people, document by document
        folder = os.path.join(output, row.doc_key)
        os.makedirs(folder, exist_ok=True)
        export.document_artifacts(result.elements, result.chunks, result.report, result.findings, row.doc_key, folder)
        export.document_json(stored, result.elements, row.doc_key, os.path.join(folder, "document.json"))
        export.table_artifacts(found, row.doc_key, os.path.join(folder, "tables"))
        export.picture_artifacts(pictures, row.doc_key, os.path.join(folder, "images"))
        export.manifest(row.asDict(True), row.doc_key, folder)
        folders.append(folder)
    return result, folders
