"""Normalisation against a row-at-a-time model written for the tests."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docstrata.functions import scalars as S
from docstrata.operators import elements as E
from docstrata.operators import scans
from docstrata.schema import ELEMENT_TYPES, LABEL_TYPES, RAW_ITEM, TYPE_CODES


def model(items, min_pages=3):
    """What every item of one document must become, each found by looking at all others. items: dicts in order."""
    text = [(x["text"] or "").strip() for x in items]
    label = [(x["label"] or "other").lower() for x in items]
    page = [next((p["page"] for p in x["prov"] or []), 1) for x in items]

    def repeated(t):
        return bool(t) and len({p["page"] for u, x in zip(text, items) if u == t for p in x["prov"] or []}) >= min_pages

    def kind(n):
        own = LABEL_TYPES.get(label[n], "other")
        if not repeated(text[n]) or own in ("header", "footer") and not re.search(r"page\s+\d+", text[n], re.I):
            return own
        return "footer" if re.search(r"page\s+\d+", text[n], re.I) else "header"

    kinds = [kind(n) for n in range(len(items))]
    code = [TYPE_CODES.get(k, "obj") for k in kinds]
    level = [{"title": 1, "section_header": max(1, x["traversal_level"] if x["level"] is None else x["level"])}.get(lab) for lab, x in zip(label, items)]

    def above(n):
        """The nearest earlier heading of a smaller level (any, for what is no heading itself)."""
        return next((m for m in range(n - 1, -1, -1) if kinds[m] == "heading" and (kinds[n] != "heading" or level[m] < level[n])), None)

    def path(n):
        m = above(n)
        return [] if m is None else [*path(m), text[m]]

    ids = [f"{x['doc_key']}_p{page[n]:03d}_{code[n]}_{sum((page[m], code[m]) == (page[n], code[n]) for m in range(n + 1)):03d}" for n, x in enumerate(items)]
    return [(ids[n], kinds[n], text[n], level[n], None if above(n) is None else ids[above(n)], path(n)) for n in range(len(items))]


@pytest.mark.parametrize("block", [4, 4096])
def test_random_documents(spark, block, monkeypatch):
    monkeypatch.setattr(scans, "BLOCK", block)
    rng = random.Random(block)
    items = []
    for doc in ("a", "b", "c"):
        for pos in range(60):
            label = rng.choice(["title", "Section_Header", "section_header", "section_header", "text", "list_item", "picture", "page_header", None, "odd"])
            text = rng.choice(["Same line", "page 7", " padded ", "", None, *[f"t{i}" for i in range(12)]])
            prov = [{"page": rng.randint(1, 5), "bbox": None} for _ in range(rng.choice([0, 1, 1, 1, 3]))]
            items.append({"doc_key": doc, "pos": pos, "label": label, "text": text, "level": rng.choice([None, 0, 1, 2, 3, 5]), "traversal_level": rng.randint(0, 4), "prov": prov})
    expected = {x for doc in ("a", "b", "c") for x in map(lambda r: (r[0], r[1], r[2], r[3], r[4], tuple(r[5])), model([i for i in items if i["doc_key"] == doc]))}
    df = E.normalize(spark.createDataFrame(items, RAW_ITEM))
    got = {(r.id, r.type, r.text, r.heading_level, r.parent_id, tuple(r.heading_path)) for r in df.collect()}
    assert got == expected
    ranked = E.children(df).collect()
    kids = {r[0]: r[4] for r in expected if r[4]}
    assert {(r.child_id, r.parent_id) for r in ranked} == set(kids.items())
    assert {c.id for c in E.roots(df).collect()} == {r[0] for r in expected if r[4] is None}
    chunk = {r.id: r.text for r in E.chunks(df).collect()}
    assert chunk == {f"chunk_{r[0]}": r[2] for r in expected if r[2] and r[1] not in ("header", "footer", "caption")}


def test_empty_input(spark):
    items = spark.createDataFrame([], RAW_ITEM)
    assert E.normalize(items).isEmpty() and E.repeated_texts(items).isEmpty() and E.outline(E.typed(items)).isEmpty()


def test_known_values(spark):
    row = spark.range(1).select(
        S.document_id(F.lit(b"stable content")).alias("doc"), S.element_id(F.lit("doc_abc"), F.lit(8), F.lit("img"), F.lit(1)).alias("el"),
        S.element_id(F.lit("d"), F.lit(1), F.lit("txt"), F.lit(1234)).alias("wide"), S.strip(F.lit(" \t x\u001c")).alias("s"),
    ).first()
    assert row.doc == "doc_ce382ddb3d23" and row.el == "doc_abc_p008_img_001" and row.wide.endswith("_1234") and row.s == "x"
    assert {"heading", "paragraph", "list_item", "table", "figure", "caption"} <= set(ELEMENT_TYPES)


def test_boxes(spark):
    schema = "document_id string, id string, provenance array<struct<page:int,bbox:struct<left:double,top:double,right:double,bottom:double,coordinate_origin:string>>>"
    nan = float("nan")
    rows = [("d", "bad", [(1, (20.0, 100.0, 10.0, 0.0, None))]), ("d", "nan", [(1, (nan, nan, 1.0, 1.0, None))]), ("d", "none", [(1, None)]), ("d", "null", None)]
    df = spark.createDataFrame(rows, schema)
    assert [r.element_id for r in E.box_findings(df).collect()] == ["bad"]
    assert E.checked_boxes(df, "quarantine").count() == 3
    with pytest.raises(Exception, match="invalid box"):
        E.checked_boxes(df).collect()


def test_ranks_by_a_string_over_ranges(spark):
    """One key holds all rows: its rows are dealt to several ranges and still ranked one after the other."""
    df = spark.range(5000).select((F.col("id") % 1).alias("k"), F.lpad(F.hash("id").cast("string"), 12, "0").alias("s"), F.lit(None).cast("int").alias("page"))
    rows = scans.with_ordinal(df, ["k", "page"], "s", [], "n").select("s", "n").collect()
    assert [r.n for r in sorted(rows)] == list(range(1, 5001))
