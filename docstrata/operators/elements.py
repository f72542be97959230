"""Raw page items to canonical elements: types, repeated headers, ids, levels and parents.

Input (schema.RAW_ITEM): one row per item, pos being unique in its document. Results for
dirty input: null labels are 'other'; null text is ''; items without provenance count as on
page 1 for ids; null provenance pages count as page 1 too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.functions import scalars as S
from docstrata.operators.scans import with_ordinal, with_running_max
from docstrata.runtime import checkpoint


def typed(items: DataFrame) -> DataFrame:
    """Label, text and type of every item, its level and its page."""
    lab = S.label(F.col("label"))
    return items.select(
        F.col("doc_key").alias("document_id"), "pos", lab.alias("label"), S.element_type(lab).alias("type"), S.strip(F.col("text")).alias("text"),
        S.heading_level(lab, F.col("level"), F.col("traversal_level")).cast("int").alias("heading_level"),
        F.coalesce(S.first_page(F.col("prov")), F.lit(1)).alias("id_page"), F.col("traversal_level"), F.col("prov").alias("provenance"),
    )


def repeated_texts(items: DataFrame, min_pages: int = 3) -> DataFrame:
    """document_id, text, n_pages of non-empty texts that stand on min_pages pages or more."""
    return _repeated(typed(items), min_pages)


def _repeated(rows: DataFrame, min_pages: int) -> DataFrame:
    at = rows.where(F.col("text") != "").select("document_id", "text", F.explode(F.transform("provenance", lambda p: p["page"])).alias("page"))
    return at.distinct().groupBy("document_id", "text").agg(F.count("page").alias("n_pages")).where(F.col("n_pages") >= min_pages)


def reclassified(items: DataFrame, min_pages: int = 3) -> DataFrame:
    """typed() with repeated texts turned into headers, or footers if they hold a page number. Blank texts, which never
    repeat and may be most of a document, stay out of the join."""
    rows = checkpoint(typed(items))
    often = _repeated(rows, min_pages).select("document_id", "text", F.lit(True).alias("repeated"))
    kind = F.when(F.col("repeated") & F.col("text").rlike(S.PAGE_NUMBER), "footer").when(F.col("repeated") & ~F.col("type").isin("header", "footer"), "header").otherwise(F.col("type"))
    judged = rows.where(F.col("text") != "").join(often, ["document_id", "text"], "left").withColumn("type", kind).drop("repeated")
    return judged.unionByName(rows.where(F.col("text") == ""))


def identified(items: DataFrame, min_pages: int = 3) -> DataFrame:
    """reclassified() with the page-aware id: ordinals count per page and type code."""
    coded = checkpoint(reclassified(items, min_pages).withColumn("code", S.type_code(F.col("type"))))
    ranked = with_ordinal(coded, ["document_id", "id_page", "code"], "pos", [], "ordinal")
    return ranked.withColumn("id", S.element_id(F.col("document_id"), F.col("id_page"), F.col("code"), F.col("ordinal"))).drop("ordinal", "code")


def stack_levels(elements: DataFrame) -> list[int]:
    """The distinct levels of headings that can be parents; depths of nesting, not data, so a handful."""
    rows = elements.where((F.col("type") == "heading") & F.col("heading_level").isNotNull()).select("heading_level").distinct().collect()
    return sorted(r[0] for r in rows)


def with_ancestors(elements: DataFrame, levels: list[int] | None = None) -> DataFrame:
    """Adds parent_id, and heading_path (texts of the ancestors, outermost first). The last heading
    of each level before a row comes from one pass; an ancestor is one that no later heading of a
    smaller or equal level closed."""
    levels = stack_levels(elements) if levels is None else levels
    if not levels:
        return elements.withColumn("parent_id", F.lit(None).cast("string")).withColumn("heading_path", F.array().cast("array<string>"))
    eligible = (F.col("type") == "heading") & F.col("heading_level").isNotNull()
    narrow = elements.select("document_id", "pos", "id", "type", "heading_level", F.when(eligible, F.col("text")).alias("text"))
    seen = with_running_max(narrow, "document_id", "pos", {f"m{k}": F.when(eligible & (F.col("heading_level") == k), F.struct(F.col("pos"), F.col("id"), F.col("text"))) for k in levels})

    # Outermost first: a heading is an ancestor if it stands later than all of smaller levels.
    last = F.array(*[F.when(~eligible | (F.col("heading_level") > k), F.col(f"m{k}")) for k in levels])
    later = lambda kept, x: F.try_element_at(kept, F.lit(-1))["pos"].isNull() | (F.try_element_at(kept, F.lit(-1))["pos"] < x["pos"])
    path = F.aggregate(last, F.array().cast(seen.select(last).schema[0].dataType), lambda kept, x: F.when(x.isNotNull() & later(kept, x), F.concat(kept, F.array(x))).otherwise(kept))
    found = seen.select("document_id", "pos", path.alias("_path"))
    found = found.select("document_id", "pos", F.try_element_at("_path", F.lit(-1))["id"].alias("parent_id"), F.transform("_path", lambda x: x["text"]).alias("heading_path"))
    return elements.join(found, ["document_id", "pos"])


def normalize(items: DataFrame, min_pages: int = 3) -> DataFrame:
    """document_id, pos, id, type, label, text, heading_level, parent_id, heading_path, provenance, ..."""
    return with_ancestors(checkpoint(identified(items, min_pages)))


def children(elements: DataFrame) -> DataFrame:
    """document_id, parent_id, child_pos (0-based), child_id, one row per child. As rows the
    children of one parent may be any number; child_arrays() gives lists."""
    kids = checkpoint(elements.where(F.col("parent_id").isNotNull()).select("document_id", "parent_id", "pos", F.col("id").alias("child_id")))
    return with_ordinal(kids, ["document_id", "parent_id"], "pos", ["child_id"], "n").select("document_id", "parent_id", (F.col("n") - 1).alias("child_pos"), "child_id")


def child_arrays(elements: DataFrame) -> DataFrame:
    """elements with children_ids, for exporters of single documents."""
    kids = elements.where(F.col("parent_id").isNotNull()).groupBy("document_id", F.col("parent_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("children_ids"))
    return elements.join(kids, ["document_id", "id"], "left").withColumn("children_ids", F.coalesce("children_ids", F.array().cast("array<string>")))


def roots(elements: DataFrame) -> DataFrame:
    return elements.where(F.col("parent_id").isNull()).select("document_id", "pos", "id")


def chunks(elements: DataFrame) -> DataFrame:
    """One chunk per element with text that is no header, footer or caption."""
    body = elements.where((F.length("text") > 0) & ~F.col("type").isin("header", "footer", "caption"))
    return body.select(F.concat(F.lit("chunk_"), "id").alias("id"), "document_id", "pos", "text", "heading_path", S.first_page(F.col("provenance")).alias("page"), F.array("id").alias("element_ids"), "type")


def outline(elements: DataFrame, first: int = 15, width: int = 70) -> DataFrame:
    """The first headings of each document, indented by level (a report, so it has a limit)."""
    heads = with_ordinal(elements.where(F.col("heading_level").isNotNull()).select("document_id", "pos", "heading_level", "text"), ["document_id"], "pos", [], "n")
    line = F.concat(F.repeat(F.lit("  "), F.col("heading_level") - 1), F.substring("text", 1, width))
    return heads.where(F.col("n") <= first).select("document_id", "n", line.alias("line"))


def box_findings(elements: DataFrame) -> DataFrame:
    """document_id, element_id, box_pos of provenances whose box is invalid."""
    at = elements.select("document_id", F.col("id").alias("element_id"), F.posexplode("provenance").alias("box_pos", "p"))
    return at.where(S.bad_box(F.col("p.bbox"))).select("document_id", "element_id", "box_pos")


def checked_boxes(elements: DataFrame, mode: str = "fail") -> DataFrame:
    """mode 'fail': an invalid box ends the job; 'quarantine': elements with one are left out (see
    box_findings)."""
    bad = F.exists(F.coalesce("provenance", F.array().cast(elements.schema["provenance"].dataType)), lambda p: S.bad_box(p["bbox"]))
    if mode == "quarantine":
        return elements.where(~bad)
    return elements.where(F.when(bad, F.raise_error(F.concat(F.lit("invalid box in "), F.col("id"))).cast("boolean")).otherwise(True))
