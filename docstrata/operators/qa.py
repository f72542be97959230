"""Deterministic checks of elements in list order.

Input: elements with document_id, pos (list position), id, type, text, reading_order,
parent_id, heading_level, provenance; documents with document_id, page_count. Every check gives
schema.FINDING rows. Results for dirty input: null and empty parents are roots; null pages and
null reading orders break no rule; a document without a page count has no page range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstrata.config import Thresholds
from docstrata.functions import scalars as S
from docstrata.operators.scans import with_running_max
from docstrata.runtime import checkpoint


def _finding(df: DataFrame, severity: str, code: str, message: Column, element: Column | None = None, page: Column | None = None) -> DataFrame:
    none = F.lit(None)
    return df.select("document_id", F.lit(severity).alias("severity"), F.lit(code).alias("code"), message.alias("message"), (none if element is None else element).cast("string").alias("element_id"), (none if page is None else page).cast("int").alias("page"))


def _page() -> Column:
    return S.first_page(F.col("provenance"))


def duplicate_ids(e: DataFrame) -> DataFrame:
    n = e.groupBy("document_id", "id").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return _finding(n, "error", "duplicate_id", F.format_string("ID occurs %d times", "n"), F.col("id"))


def missing_parents(e: DataFrame) -> DataFrame:
    ids = e.select("document_id", F.col("id").alias("parent_id")).distinct()
    lost = e.where(F.length("parent_id") > 0).join(ids, ["document_id", "parent_id"], "left_anti")
    return _finding(lost, "error", "missing_parent", F.lit("Parent reference does not exist"), F.col("id"), _page())


def _listed(e: DataFrame) -> DataFrame:
    """Every row with the row before it and the heading before it: one pass for both rules of list order."""
    narrow = e.select("document_id", "pos", "id", "reading_order", "heading_level", _page().alias("page"))
    return with_running_max(narrow, "document_id", "pos", {"before": F.struct("pos", "reading_order"), "heading": F.when(F.col("heading_level").isNotNull(), F.struct("pos", "heading_level"))})


def _late() -> Column:
    return F.coalesce(F.col("reading_order") <= F.when(F.col("before").isNull(), F.lit(-1)).otherwise(F.col("before.reading_order")), F.lit(False))


def _jump(most: int) -> Column:
    return F.coalesce(F.col("heading_level") - F.col("heading.heading_level") > most, F.lit(False))


def list_order(e: DataFrame, most: int = 1, order: bool = True, jumps: bool = True) -> DataFrame:
    """Rows that don't exceed the row just before them, and headings more than most levels below the one before."""
    late = F.when(_late(), F.struct(F.lit("error").alias("severity"), F.lit("reading_order").alias("code"), F.lit("Reading order is not strictly increasing").alias("message"))) if order else None
    jump = F.when(_jump(most), F.struct(F.lit("warning").alias("severity"), F.lit("heading_jump").alias("code"), F.format_string("Heading jumps from H%d to H%d", "heading.heading_level", "heading_level").alias("message"))) if jumps else None
    at = _listed(e).select("document_id", "id", "page", F.explode(F.array_compact(F.array(*[c for c in (late, jump) if c is not None]))).alias("f"))
    return at.select("document_id", "f.severity", "f.code", "f.message", F.col("id").cast("string").alias("element_id"), F.col("page").cast("int").alias("page"))


def reading_order(e: DataFrame) -> DataFrame:
    """Rows that don't exceed the row just before them in list order."""
    return list_order(e, jumps=False)


def page_range(e: DataFrame, documents: DataFrame) -> DataFrame:
    at = e.select("document_id", "id", F.explode(F.transform("provenance", lambda p: p["page"])).alias("page")).join(documents.select("document_id", "page_count"), "document_id")
    out = at.where((F.col("page") < 1) | (F.col("page") > F.col("page_count")))
    return _finding(out, "error", "page_range", F.lit("Element points outside the document"), F.col("id"), F.col("page"))


def heading_jumps(e: DataFrame, most: int = 1) -> DataFrame:
    return list_order(e, most, order=False)


def metrics(e: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per document of documents, with zeros where it has no elements."""
    count = lambda kind: F.count_if(F.col("type") == kind)
    per = e.groupBy("document_id").agg(
        F.count("*").alias("elements"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("text_characters"), F.count("heading_level").alias("headings"),
        count("table").alias("tables"), count("figure").alias("figures"), count("list_item").alias("lists"),
    )
    numbers = ["elements", "text_characters", "headings", "tables", "figures", "lists"]
    return documents.select("document_id", F.col("page_count").alias("pages")).join(per, "document_id", "left").select("document_id", "pages", *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers])


def whole_document(m: DataFrame, t: Thresholds) -> DataFrame:
    """Findings on page count and amount of text, from metrics()."""
    low = _finding(m.where(F.col("text_characters") < t.minimum_text_characters), "error", "low_text", F.format_string("Only %d text characters extracted", "text_characters"))
    if t.expected_pages is None:
        return low
    wrong = m.where(~F.col("pages").eqNullSafe(F.lit(t.expected_pages)))
    got = F.coalesce(F.col("pages").cast("string"), F.lit("none"))
    return _finding(wrong, "error", "page_count", F.concat(F.lit(f"Expected {t.expected_pages} pages, got "), got)).unionAll(low)


def findings(e: DataFrame, documents: DataFrame, t: Thresholds | None = None, m: DataFrame | None = None) -> DataFrame:
    """e should be a stored table: every rule reads it. m: metrics() if they are known."""
    t = t or Thresholds()
    parts = [duplicate_ids(e), missing_parents(e), list_order(e, t.maximum_heading_level_jump), page_range(e, documents), whole_document(metrics(e, documents) if m is None else m, t)]
    return reduce(DataFrame.unionByName, parts)


def report(e: DataFrame, documents: DataFrame, t: Thresholds | None = None) -> DataFrame:
    """metrics() with errors, warnings and passed."""
    m = checkpoint(metrics(e, documents))
    n = findings(e, documents, t, m).groupBy("document_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    rows = m.join(n, "document_id", "left")
    return rows.withColumns({"errors": F.coalesce("errors", F.lit(0)), "warnings": F.coalesce("warnings", F.lit(0))}).withColumn("passed", F.col("errors") == 0)
