"""Files to frames: documents, table indexes, sources to convert."""

from __future__ import annotations

import json
import platform
import time
from collections.abc import Callable, Iterator
from dataclasses import asdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docstrata.config import Config
from docstrata.functions import scalars as S
from docstrata.schema import CONVERSION, DOCUMENT, TABLE


def documents(spark: SparkSession, path: str) -> DataFrame:
    """document.json files (any glob); a file that doesn't fit the schema ends the job."""
    return spark.read.schema(DOCUMENT).option("multiLine", True).option("mode", "FAILFAST").json(path)


def table_index(spark: SparkSession, paths: list[str]) -> DataFrame:
    """tables/index.json of the runs that have one."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    there = [p for p in paths if (f := spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(hadoop).exists(f)]
    if not there:
        return spark.createDataFrame([], TABLE)
    return spark.read.schema(TABLE).option("multiLine", True).json(there)


def inspect(spark: SparkSession, path: str, page_count: Callable[[bytes], int] | None = None) -> DataFrame:
    """path, document_id, size and pages (null without a counter) of source files."""
    files = spark.read.format("binaryFile").load(path)
    rows = files.select("path", S.document_id(F.col("content")).alias("document_id"), F.col("length").alias("size"), "content")
    if page_count is None:
        return rows.select("path", "document_id", "size", F.lit(None).cast("int").alias("pages"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([page_count(x) for x in b.column(3).to_pylist()], pa.int32())], names=["path", "document_id", "size", "pages"])

    return rows.mapInArrow(run, "path string, document_id string, size bigint, pages int")


def convert(spark: SparkSession, path: str, converter: Callable[..., dict | list], config: Config | None = None) -> DataFrame:
    """Run a converter, which the caller gives, over source files: one row of schema.CONVERSION per file; none is bundled.

    converter(path, content, options) gets converter_options() and returns the page items as a list, or a dict with any of
    items, tables, pictures, page_count, raw (file name -> text), errors, version; all in the fields of schema.CONVERSION.
    A failing file gives a row with status 'failure' and its error, and the others go on."""
    options, described = converter_options(config or Config()), json.dumps(asdict(config or Config()))
    kinds = T.StructType.fromDDL(CONVERSION)
    files = spark.read.format("binaryFile").load(path).select("path", S.document_id(F.col("content")).alias("doc_key"), F.sha2("content", 256).alias("sha"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kinds)
        for batch in batches:
            for where, key, sha, content in zip(*(c.to_pylist() for c in batch.columns)):
                began = time.perf_counter()
                try:
                    made = converter(where, content, options)
                    made = {"items": made} if isinstance(made, list) else made
                    status = "failure" if made.get("status") == "failure" else "success"
                except Exception as e:  # one file must not end the job
                    made, status = {"errors": [f"{type(e).__name__}: {e}"]}, "failure"
                filled = [{"label": "other", "text": "", "traversal_level": 1, "prov": [], **x} for x in made.get("items", [])]
                row = {
                    "doc_key": key, "source": where, "content_sha256": sha, "page_count": made.get("page_count"), "status": status, "errors": [str(e) for e in made.get("errors", [])],
                    "duration_seconds": round(time.perf_counter() - began, 3), "python_version": platform.python_version(), "converter_version": str(made.get("version", "unknown")), "config": described,
                    "items": filled, "tables": made.get("tables", []), "pictures": made.get("pictures", []), "raw": list((made.get("raw") or {}).items()),
                }
                yield pa.RecordBatch.from_pylist([row], schema=arrow)

    return files.mapInArrow(run, kinds)


def converter_options(config: Config) -> dict:
    """What a converter is told: recognition, tables, pictures."""
    return {
        "ocr": config.ocr.enabled, "ocr_languages": list(config.ocr.languages), "force_full_page_ocr": config.ocr.force_full_page, "table_structure": True, "table_mode": config.tables.mode,
        "cell_matching": config.tables.do_cell_matching, "images_scale": config.image_scale, "page_images": config.generate_page_images, "picture_images": config.generate_picture_images,
    }


def raw_items(conversions: DataFrame) -> DataFrame:
    """schema.RAW_ITEM rows of converted files."""
    return conversions.select("doc_key", F.posexplode("items").alias("pos", "i")).select("doc_key", F.col("pos").cast("bigint").alias("pos"), "i.*")


def raw_tables(conversions: DataFrame) -> DataFrame:
    return conversions.select("doc_key", F.posexplode("tables").alias("pos", "t")).select("doc_key", F.col("pos").cast("bigint").alias("pos"), "t.*")


def raw_pictures(conversions: DataFrame) -> DataFrame:
    """Pictures with the hash of their bytes; those without bytes keep their place and have no hash."""
    rows = conversions.select("doc_key", F.posexplode("pictures").alias("pos", "p")).select("doc_key", F.col("pos").cast("bigint").alias("pos"), "p.*")
    return rows.withColumn("image_hash", F.sha2("content", 256))


def page_text(elements: DataFrame, document_id: str, pages: int = 2, characters: int = 800) -> DataFrame:
    """page, text: the beginning of a document's first pages (a look at it, so it has a limit)."""
    mine = elements.where(F.col("document_id") == document_id).select(S.first_page(F.col("provenance")).alias("page"), "pos", "text").where(F.col("page") <= pages)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n")
    return mine.groupBy("page").agg(F.substring(text, 1, characters).alias("text")).orderBy("page").limit(pages)


def first_assets(index: DataFrame, n: int = 5) -> DataFrame:
    """The first entries of a picture index, for a look at it."""
    return index.select("id", "page", "kind", "complexity", "image_path").limit(n)


def artifacts(spark: SparkSession, output: str, name: str) -> DataFrame:
    """All files of a name ('images/index.json', 'qa/report.json') below the documents of an output folder."""
    return spark.read.option("multiLine", True).json(f"{output.rstrip('/')}/doc_*/{name}")
