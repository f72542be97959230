import numpy as np
from pyspark.sql import functions as F

from docstrata.config import Config, Thresholds
from docstrata.operators import images, qa, tables
from docstrata.plans import pipeline
from docstrata.schema import RAW_ITEM
from docstrata.sources import export

ELEMENT = "document_id string, pos bigint, id string, type string, text string, reading_order int, parent_id string, heading_level int, provenance array<struct<page:int>>"
CELLS = "id string, num_rows int, num_columns int, cells array<struct<text:string,row:int,column:int,row_span:int,column_span:int,is_header:boolean>>"


def codes(spark, rows, pages=1, t=None):
    e = spark.createDataFrame([("d", i, *r) for i, r in enumerate(rows)], ELEMENT)
    docs = spark.createDataFrame([("d", pages)], "document_id string, page_count int")
    t = t or Thresholds(expected_pages=1, minimum_text_characters=1)
    return sorted((r.code, r.element_id) for r in qa.findings(e, docs, t).collect()), qa.report(e, docs, t).first()


def test_valid_document_passes(spark):
    found, report = codes(spark, [("e", "paragraph", "valid", 0, None, None, [])])
    assert found == [] and report.passed


def test_each_rule(spark):
    assert codes(spark, [("e", "paragraph", "x", 0, "missing", None, [])])[0] == [("missing_parent", "e")]
    assert codes(spark, [("e", "paragraph", "x", 0, "", None, None)])[0] == []
    assert codes(spark, [("e", "paragraph", "x", 0, None, None, []), ("e", "paragraph", "x", 1, None, None, [])])[0] == [("duplicate_id", "e")]
    assert codes(spark, [("a", "paragraph", "x", 5, None, None, []), ("b", "paragraph", "x", 5, None, None, [])])[0] == [("reading_order", "b")]
    assert codes(spark, [("a", "paragraph", "x", 0, None, None, [(0,), (1,), (2,), (None,)])])[0] == [("page_range", "a")] * 2
    jump = [("a", "heading", "x", 0, None, 1, []), ("b", "paragraph", "x", 1, None, None, []), ("c", "heading", "x", 2, None, 3, []), ("d", "heading", "x", 3, None, 1, [])]
    found, report = codes(spark, jump)
    assert found == [("heading_jump", "c")] and report.passed and report.warnings == 1
    assert codes(spark, [("a", "paragraph", None, 0, None, None, [])])[0] == [("low_text", None)]
    assert codes(spark, [("a", "paragraph", "x", 0, None, None, [])], pages=2)[0] == [("page_count", None)]
    assert codes(spark, [("a", "paragraph", "x", 0, None, None, [])], pages=None)[0] == [("page_count", None)]


def test_table_quality(spark):
    rows = [
        ("span", 2, 2, [("h", 0, 0, 1, 2, True), ("a", 1, 0, 1, 1, False), ("b", 1, 1, None, None, None)]),
        ("none", 3, 3, None), ("empty", 0, 0, []), ("blank", 1, 1, [(" ", 0, 0, 1, 1, False), None]), ("over", 1, 1, [("a", 0, 0, 3, 3, None)]),
    ]
    got = {r.id: (r.fill_ratio, r.spanning_cells, r.header_cells, r.n_cells) for r in tables.quality(spark.createDataFrame(rows, CELLS)).collect()}
    assert got == {"span": (1.0, 1, 1, 3), "none": (0.0, 0, 0, 0), "empty": (0.0, 0, 0, 0), "blank": (0.0, 0, 0, 1), "over": (1.0, 1, 0, 1)}
    assert tables.compare({"x": spark.createDataFrame(rows, CELLS), "y": spark.createDataFrame([], CELLS)}).count() == 5


def test_pictures(spark):
    raw = spark.createDataFrame(
        [("d", 0, 1, "A", "photo", "p1", "c1", "x"), ("d", 1, 1, None, None, None, None, "x"), ("d", 2, 1, "A", None, None, None, "x"), ("d", 3, 1, "B", "logo/icon", "p2", None, "x")],
        "doc_key string, pos int, page int, image_hash string, kind string, image_path string, caption string, n string",
    )
    raw = raw.drop("n").withColumns({"complexity": F.lit("simple"), "classification_confidence": F.lit(0.5), "prompt": F.lit("?")})
    rows = images.inherited(images.occurrences(raw))
    got = sorted((r.occurrence_id[-3:], r.is_duplicate, r.caption) for r in rows.collect())
    assert got == [("001", False, "c1"), ("003", True, "c1"), ("004", False, None)]
    summary = images.hash_summary(rows).first()
    assert (summary.total_occurrences, summary.unique_images, summary.duplicate_occurrences) == (3, 2, 1)

    def hook(path, prompt):
        if path == "p1":
            raise ValueError("secret")
        return "never"

    made = sorted((r.occurrence_id[-3:], r.caption, r.caption_failed) for r in images.captioned(rows, hook).collect())
    assert made == [("001", images.FAILED, True), ("003", images.FAILED, True), ("004", None, None)]
    assert images.captioned(rows, None).where("caption IS NOT NULL").isEmpty()


def test_pixel_statistics():
    flat = np.zeros((10, 10), np.uint8)
    assert images.pixel_statistics(flat, np.zeros((10, 10, 3), np.uint8)) == (0.0, 1)
    flat[5, 5] = 255
    assert images.pixel_statistics(flat, np.zeros((10, 10, 3), np.uint8))[0] > 0


def test_config(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("qa: {expected_pages: 3}\ntables: {mode: fast}\nunknown: 1\n")
    c = Config.from_yaml(str(p))
    assert c.qa.expected_pages == 3 and c.tables.mode == "fast" and c.repeated_text_min_pages == 3
    p.write_text("")
    assert Config.from_yaml(str(p)) == Config()


def test_pipeline_and_export(spark, tmp_path):
    items = spark.createDataFrame([("d", 0, "title", "T<b>", None, 1, [(1, None)]), ("d", 1, "text", "body", None, 1, [(9, None)])], RAW_ITEM)
    docs = spark.createDataFrame([("d", "f", "0", 1)], "doc_key string, source_name string, content_sha256 string, page_count int")
    r = pipeline.run(docs, items)
    assert r.manifest.first().status == "failed" and {f.code for f in r.findings.collect()} == {"page_range", "low_text"}
    export.store(r.elements, str(tmp_path / "e"))
    export.json_lines(r.chunks, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "e")).count() == 2 and spark.read.json(str(tmp_path / "c")).count() == 2
    export.document_artifacts(r.elements, r.chunks, r.report, r.findings, "d", str(tmp_path / "doc"))
    assert "page_range" in (tmp_path / "doc/qa/report.html").read_text()
    files = export.table_files({"id": "t", "num_rows": 1, "num_columns": 2, "cells": [{"text": "<a>", "row": 0, "column": 0}, None]})
    assert "&lt;a&gt;" in files["html"] and files["csv"] == "<a>,\n"
