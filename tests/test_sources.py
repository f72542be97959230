import json

import pytest
from pyspark.sql import functions as F

from docstrata import cli
from docstrata.operators import images
from docstrata.plans import pipeline
from docstrata.sources import readers
from docstrata.streaming import inbox


def test_inspect_and_convert(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"stable content")
    path = str(tmp_path / "*.bin")
    row = readers.inspect(spark, path).first()
    assert (row.document_id, row.size, row.pages) == ("doc_ce382ddb3d23", 14, None)
    assert readers.inspect(spark, path, len).first().pages == 14
    made = readers.convert(spark, path, lambda p, content, options: [{"label": "title", "text": content.decode()}, {"text": "x", "prov": [{"page": 2, "bbox": None}]}])
    got = [(r.doc_key, r.pos, r.label, r.text, [p.page for p in r.prov]) for r in readers.raw_items(made).orderBy("pos").collect()]
    assert got == [("doc_ce382ddb3d23", 0, "title", "stable content", []), ("doc_ce382ddb3d23", 1, "other", "x", [2])]


def convert_fixture(path, content, options):
    """What a converter gives for a page with a heading, a paragraph, a table and three pictures, two of them equal."""
    if content == b"broken":
        raise ValueError("not a document")
    assert options["table_mode"] == "accurate" and options["ocr_languages"] == ["en"]
    at = [{"page": 1, "bbox": {"left": 0.0, "top": 9.0, "right": 5.0, "bottom": 1.0, "coordinate_origin": "x"}}]
    cell = lambda r, c, text, header, to: {"start_row": r, "end_row": r + 1, "start_col": c, "end_col": to, "text": text, "column_header": header, "row_header": False}
    noise = bytes((7 * i * i) % 251 for i in range(3 * 300 * 450))
    picture = {"page": 1, "bbox": None, "ocr_text": "Fig", "content": b"png", "width": 300, "height": 450, "rgb": noise}
    return {
        "page_count": 1, "items": [{"label": "title", "text": "T", "prov": at}, {"label": "text", "text": "y" * 120, "prov": at}], "version": "1.2", "raw": {"text.md": "# T"},
        "tables": [{"prov": at, "cells": [cell(0, 0, "A & B", True, 2), cell(1, 0, "1", False, 1), cell(1, 1, "2", False, 2)], "num_rows": 2, "num_cols": 2}],
        "pictures": [picture, picture | {"content": None}, picture | {"ocr_text": None}, picture | {"content": b"other", "rgb": None}],
    }


def test_run_from_sources_and_back(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.bin").write_bytes(b"stable content")
    (tmp_path / "in" / "b.bin").write_bytes(b"broken")
    out = str(tmp_path / "out")
    (tmp_path / "c.yaml").write_text("qa: {expected_pages: 1}")
    assert cli.main(["extract-images", str(tmp_path / "in"), out, "--converter", "tests.test_sources:convert_fixture", "--config", str(tmp_path / "c.yaml")]) == 0
    assert f"{out}/doc_ce382ddb3d23/images" in capsys.readouterr().out
    doc = tmp_path / "out" / "doc_ce382ddb3d23"
    tree = json.loads((doc / "document.json").read_text())
    title, text = tree["elements"]
    assert tree["root_ids"] == [title["id"]] and title["children_ids"] == [text["id"]] and text["parent_id"] == title["id"] and tree["page_count"] == 1
    assert cli.main(["evaluate", str(doc / "document.json"), "--config", str(tmp_path / "c.yaml")]) == 0
    index = json.loads((doc / "tables" / "index.json").read_text())
    assert [c["column_span"] for c in index[0]["cells"]] == [2, 1, 1] and (doc / "tables" / f"{index[0]['id']}.csv").exists() and "A &amp; B" in (doc / "tables" / f"{index[0]['id']}.html").read_text()
    assert json.loads((doc / "tables" / f"{index[0]['id']}.json").read_text())["files"] == {}
    assert cli.main(["compare-tables", str(tmp_path / "cmp"), "--run", f"a={doc}/tables/index.json"]) == 0
    assert spark.read.json(str(tmp_path / "cmp")).first().fill_ratio == 1.0
    pictures, hashes = (json.loads((doc / "images" / f).read_text()) for f in ("index.json", "hashes.json"))
    assert [p["id"][-3:] for p in pictures] == ["001", "003", "004"] and [p["is_duplicate"] for p in pictures] == [False, True, False]
    assert (hashes["total_occurrences"], hashes["unique_images"], hashes["duplicate_occurrences"]) == (3, 2, 1) and pictures[0]["id"] in hashes["hash_to_image_id"].values()
    assert pictures[0]["kind"] == pictures[1]["kind"] != "unknown" and pictures[2]["kind"] == "unknown" and len(list((doc / "images").glob("*.png"))) == 2
    assert readers.first_assets(readers.artifacts(spark, out, "images/index.json")).count() == 3
    facts = json.loads((doc / "manifest.json").read_text())
    assert facts["status"] == "success" and facts["converter_version"] == "1.2" and facts["config"]["tables"]["mode"] == "accurate" and (doc / "raw" / "text.md").read_text() == "# T"
    failed = [json.loads(p.read_text()) for p in (tmp_path / "out").glob("*/manifest.json") if p.parent != doc]
    assert [(f["status"], f["errors"]) for f in failed] == [("failure", ["ValueError: not a document"])]
    with pytest.raises(SystemExit):
        cli.main(["run-all", str(tmp_path / "none.pdf"), out, "--converter", "tests.test_sources:convert_fixture"])


def test_answers_of_a_caption_service(spark):
    cases = {'{"candidates": []}': images.NO_CANDIDATES, "{}": images.NO_CANDIDATES, '{"candidates": [{"content": {"parts": []}}]}': images.EMPTY_ANSWER, '{"candidates": [{"content": {"parts": [{"text": " a"}, {"text": "b "}]}}, {}]}': "ab"}
    df = spark.createDataFrame([(k,) for k in cases], "answer string")
    assert {r.answer: r.text for r in df.select("answer", images.answer_text(F.col("answer")).alias("text")).collect()} == cases
    assert spark.range(1).select(images.payload(F.lit(b"png"))).first()[0] == "cG5n"


def test_text_of_the_first_pages(spark):
    rows = spark.createDataFrame([("d", n, f"line {n}", [(1 + n // 2,)]) for n in range(8)], "document_id string, pos bigint, text string, provenance array<struct<page:int>>")
    assert [(r.page, r.text) for r in readers.page_text(rows, "d", 2, 10).collect()] == [(1, "line 0\nlin"), (2, "line 2\nlin")]


def test_stored_documents(spark, tmp_path):
    element = {"id": "e", "type": "paragraph", "text": "x" * 200, "reading_order": 0, "parent_id": "missing", "provenance": []}
    (tmp_path / "document.json").write_text(json.dumps({"id": "d", "page_count": 1, "elements": [element, None], "root_ids": []}, indent=1))
    report = pipeline.evaluate(readers.documents(spark, str(tmp_path / "document.json"))).first()
    assert report.errors == 1 and not report.passed and report.text_characters == 200
    assert cli.main(["evaluate", str(tmp_path / "document.json")]) == 1


def test_table_index(spark, tmp_path):
    assert readers.table_index(spark, [str(tmp_path / "none.json")]).isEmpty()
    (tmp_path / "index.json").write_text(json.dumps([{"id": "t", "num_rows": 1, "num_columns": 1, "cells": [{"text": "a", "row": 0, "column": 0}]}]))
    index = str(tmp_path / "index.json")
    assert readers.table_index(spark, [index, str(tmp_path / "none.json")]).count() == 1
    assert cli.main(["compare-tables", str(tmp_path / "out"), "--run", f"a={index}", "--run", f"b={index}"]) == 0
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_run_command(spark, tmp_path):
    spark.createDataFrame([("d", "f", "0", 1)], "doc_key string, source_name string, content_sha256 string, page_count int").write.parquet(str(tmp_path / "docs"))
    spark.createDataFrame([("d", 0, "title", "T", None, 1, None)], "doc_key string, pos bigint, label string, text string, level int, traversal_level int, prov array<struct<page:int,bbox:struct<left:double,top:double,right:double,bottom:double,coordinate_origin:string>>>").write.parquet(str(tmp_path / "items"))
    assert cli.main(["run", str(tmp_path / "docs"), str(tmp_path / "items"), str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out/chunks")).first().text == "T"


def test_inbox(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP '2024-01-01'), ('a', TIMESTAMP '2024-01-02'), ('b', TIMESTAMP '2024-01-01') AS t(id, loaded_at)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = inbox.elements_stream(spark, str(tmp_path / "in"), rows.schema)
    inbox.run(stream, lambda df: df.groupBy("id").count(), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    assert {(r.id, r["count"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("a", 1), ("b", 1)}


def test_inbox_keeps_late_rows(spark, tmp_path):
    where = [str(tmp_path / x) for x in ("in", "out", "state")]
    deliveries = ["('a', '2024-12-01'), (NULL, '2024-01-01')", "('b', '2024-01-01'), ('b', '2024-12-02'), ('a', '2024-12-30')", "('c', '2023-01-01'), ('a', '2024-06-01'), ('b', '2023-01-01')"]
    for d in deliveries:
        rows = spark.sql(f"SELECT id, CAST(t AS timestamp) AS loaded_at FROM VALUES {d} AS t(id, t)")
        rows.coalesce(1).write.mode("append").parquet(where[0])
        inbox.run(inbox.elements_stream(spark, where[0], rows.schema), lambda df: df.select("id"), *where[1:]).awaitTermination(120)
    assert sorted(str(r.id) for r in spark.read.parquet(where[1]).collect()) == ["None", "a", "b", "c"]
