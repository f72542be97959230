"""Queries of the core operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.config import Thresholds
from docstrata.functions import scalars as S
from docstrata.operators import elements as E
from docstrata.operators import hierarchy, images, qa, shred, tables
from docstrata.runtime import checkpoint, table
from docstrata.schema import BBOX, DOCUMENT, LABEL_TYPES, TABLE, TYPE_CODES
from docstrata.sources import adapters as A

Query = Callable[[SparkSession, str], DataFrame]
SEPARATOR = " > "
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return shred.found_members(table(spark, d, "canonical_documents"), table(spark, d, "extracted_tables"))


@query
def p4_adjacency(spark: SparkSession, d: str) -> DataFrame:
    """The adjacency table of the latest deliveries of documents and tables."""
    docs = shred.latest(table(spark, d, "canonical_documents"), "id", "delivered_at")
    tabs = shred.latest(table(spark, d, "extracted_tables"), "id", "delivered_at")
    return shred.shred(docs, "id", "document").select(F.lit("document").alias("entity"), "*").unionAll(shred.shred(tabs, "id", "table").select(F.lit("table"), "*"))


def _member_rows(spark: SparkSession, d: str) -> DataFrame:
    docs = shred.latest(table(spark, d, "canonical_documents").select("id", "elements", "delivered_at"), "id", "delivered_at").select("id", "elements")
    return checkpoint(shred.shred(docs, "id", "document"))


ELEMENT_FIELDS = ["id", "document_id", "type", "text", "reading_order", "parent_id", "heading_level", "metadata.docling_label", "metadata.traversal_level"]
PROVENANCE_FIELDS = ["page", "source", "confidence", "bbox.left", "bbox.top", "bbox.right", "bbox.bottom", "bbox.coordinate_origin"]


@query
def p4_elements(spark: SparkSession, d: str) -> DataFrame:
    """The entity table of elements with the document they stand in and their place in it."""
    rows = shred.entities(_member_rows(spark, d), "elements", ELEMENT_FIELDS)
    return rows.select(F.col("parent").alias("parent_key"), F.col("ordinal").alias("child_pos"), *[f.replace(".", "_") for f in ELEMENT_FIELDS])


@query
def p4_provenance(spark: SparkSession, d: str) -> DataFrame:
    """The entity table of provenance: the place of the element in its document, and in the element."""
    rows = shred.entities(_member_rows(spark, d), "provenance", PROVENANCE_FIELDS)
    place = F.regexp_extract("parent", r"\[(\d+)\]$", 1).cast("int")
    return rows.select(F.col("key").alias("document_key"), place.alias("element_pos"), F.col("ordinal").alias("child_pos"), *[f.replace(".", "_") for f in PROVENANCE_FIELDS])


@query
def p4_cells(spark: SparkSession, d: str) -> DataFrame:
    """The entity table of cells, put together from the adjacency table."""
    tabs = shred.latest(table(spark, d, "extracted_tables").select("id", "cells", "delivered_at"), "id", "delivered_at").select("id", "cells")
    fields = ["text", "row", "column", "row_span", "column_span", "is_header"]
    return shred.entities(checkpoint(shred.shred(tabs, "id", "table")), "cells", fields).select(F.col("parent").alias("table_id"), F.col("ordinal").alias("child_pos"), *fields)


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.link_states(table(spark, d, "canonical_elements"))


@query
def p7_trees(spark: SparkSession, d: str) -> DataFrame:
    """Root, depth, path and number of descendants of every element."""
    tree = hierarchy.trees(table(spark, d, "canonical_elements"), counts=True)
    return tree.select("document_id", "element_id", "root_id", "depth", F.array_join("path", "/").alias("path"), "n_descendants", "link_state")


@query
def p7_descendants(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.descendants(hierarchy.trees(table(spark, d, "canonical_elements")))


@query
def inspect_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", S.document_id(F.col("text").cast("binary")).alias("document_id"), F.length("text").alias("n_characters"))


@query
def element_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return E.typed(A.raw_items(spark, d, False)).groupBy("type").agg(F.count("*").alias("n"))


@query
def heading_levels(spark: SparkSession, d: str) -> DataFrame:
    return E.typed(A.raw_items(spark, d, False)).groupBy("label", "heading_level").agg(F.count("*").alias("n"))


@query
def repeated_texts(spark: SparkSession, d: str) -> DataFrame:
    return E.repeated_texts(A.raw_items(spark, d))


@query
def header_footer_reclass(spark: SparkSession, d: str) -> DataFrame:
    return E.reclassified(A.raw_items(spark, d)).select("document_id", "pos", "label", "type")


@query
def canonical_elements(spark: SparkSession, d: str) -> DataFrame:
    return E.identified(A.raw_items(spark, d)).select("document_id", "pos", "id", "type", "heading_level")


@query
def parent_links(spark: SparkSession, d: str) -> DataFrame:
    return E.normalize(A.raw_items(spark, d)).select("document_id", "id", "parent_id")


@query
def children_ids(spark: SparkSession, d: str) -> DataFrame:
    return E.children(E.normalize(A.raw_items(spark, d)))


@query
def document_roots(spark: SparkSession, d: str) -> DataFrame:
    return E.roots(E.normalize(A.raw_items(spark, d))).select("document_id", "id")


@query
def heading_path(spark: SparkSession, d: str) -> DataFrame:
    return E.normalize(A.raw_items(spark, d)).select("document_id", "id", F.array_join("heading_path", SEPARATOR).alias("heading_path"))


@query
def chunks(spark: SparkSession, d: str) -> DataFrame:
    c = E.chunks(E.normalize(A.raw_items(spark, d)))
    return c.select("id", "document_id", "text", F.array_join("heading_path", SEPARATOR).alias("heading_path"), "page", F.array_join("element_ids", ",").alias("element_ids"), "type")


@query
def heading_outline(spark: SparkSession, d: str) -> DataFrame:
    return E.outline(E.typed(A.raw_items(spark, d)))


@query
def bbox_invalid(spark: SparkSession, d: str) -> DataFrame:
    return E.box_findings(A.single(table(spark, d, "canonical_elements").select("id", "document_id", "provenance", "loaded_at")))


def _extracted(spark: SparkSession, d: str) -> DataFrame:
    raw = A.latest_tables(spark, d).select(
        F.col("document_id").alias("doc_key"), F.col("id").alias("pos"), F.transform(F.array("page"), lambda p: F.struct(p.alias("page"), F.lit(None).cast(BBOX).alias("bbox"))).alias("prov"),
        F.transform(F.filter("cells", lambda c: c.isNotNull()), lambda c: F.struct(c["row"].alias("start_row"), (c["row"] + F.coalesce(c["row_span"], F.lit(1))).alias("end_row"), c["column"].alias("start_col"), (c["column"] + F.coalesce(c["column_span"], F.lit(1))).alias("end_col"), c["text"].alias("text"), c["is_header"].alias("column_header"), F.lit(False).alias("row_header"))).alias("cells"),
        "num_rows", F.col("num_columns").alias("num_cols"),
    )
    return tables.extract(raw, "adapter")


@query
def tables_extracted(spark: SparkSession, d: str) -> DataFrame:
    """Ids of the latest tables, counted per page again."""
    t = _extracted(spark, d)
    return t.select("id", "document_id", "page", "num_rows", "num_columns", F.when(F.col("cells").isNull(), 0).otherwise(F.size("cells")).alias("n_cells"))


@query
def tables_cells(spark: SparkSession, d: str) -> DataFrame:
    """Every cell of the extracted tables with its span and header flag."""
    at = _extracted(spark, d).select(F.col("id").alias("table_id"), F.posexplode("cells").alias("cell_pos", "c"))
    return at.select("table_id", "cell_pos", "c.*")


@query
def table_quality(spark: SparkSession, d: str) -> DataFrame:
    return tables.quality(A.latest_tables(spark, d))


@query
def table_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Quality by run, a run being a method of extraction (a handful of names)."""
    latest = checkpoint(A.latest_tables(spark, d).withColumn("method", F.coalesce("method", F.lit(""))))
    runs = sorted(r[0] for r in latest.select("method").distinct().collect()) or [""]
    return tables.compare({run: latest.where(F.col("method") == run) for run in runs})


@query
def image_occurrences(spark: SparkSession, d: str) -> DataFrame:
    return images.occurrences(A.raw_pictures(spark, d)).select(F.col("pos").alias("image_id"), "occurrence_id", "image_hash")


@query
def image_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = images.inherited(images.occurrences(A.raw_pictures(spark, d)))
    return rows.select("occurrence_id", "first_id", "is_duplicate", "kind", "complexity", "image_path", "caption")


@query
def image_hash_summary(spark: SparkSession, d: str) -> DataFrame:
    return images.hash_summary(images.deduplicated(images.occurrences(A.raw_pictures(spark, d))))


@query
def image_first_ids(spark: SparkSession, d: str) -> DataFrame:
    """The map from hashes to the first picture of each document, as rows."""
    return images.first_ids(images.deduplicated(images.occurrences(A.raw_pictures(spark, d))))


@query
def image_kind(spark: SparkSession, d: str) -> DataFrame:
    """Vectors stand for pictures: the share of large components for edges, ids for sizes."""
    v = table(spark, d, "embeddings").select(
        "vec_id", (F.size(F.filter("embedding", lambda x: F.abs(x) > 0.15)) / (F.size("embedding") + 1)).alias("edge_density"), (F.col("vec_id") * 37 % 9000).alias("color_count"), (F.col("vec_id") % 600).alias("width"), (F.col("vec_id") % 350).alias("height")
    )
    return images.classified(v).select("vec_id", "kind", "complexity", "confidence", F.array_join("reasons", ";").alias("reasons"))


@query
def caption_prompts(spark: SparkSession, d: str) -> DataFrame:
    rows = images.deduplicated(images.occurrences(A.raw_pictures(spark, d))).where(~F.col("is_duplicate") & ~F.coalesce(F.col("kind") == "logo/icon", F.lit(False)))
    return rows.select("occurrence_id", S.caption_prompt(F.col("page"), F.lit(None).cast("string"), F.col("kind"), F.col("ocr_text")).alias("prompt"))


@query
def qa_duplicate_id(spark: SparkSession, d: str) -> DataFrame:
    return qa.duplicate_ids(A.delivered(spark, d))


@query
def qa_missing_parent(spark: SparkSession, d: str) -> DataFrame:
    return qa.missing_parents(A.delivered(spark, d))


@query
def qa_reading_order(spark: SparkSession, d: str) -> DataFrame:
    return qa.reading_order(A.delivered(spark, d))


@query
def qa_page_range(spark: SparkSession, d: str) -> DataFrame:
    return qa.page_range(A.delivered(spark, d), A.page_counts(spark, d))


@query
def qa_heading_jump(spark: SparkSession, d: str) -> DataFrame:
    return qa.heading_jumps(A.delivered(spark, d))


@query
def qa_findings(spark: SparkSession, d: str) -> DataFrame:
    return qa.findings(A.delivered(spark, d), A.page_counts(spark, d))


EXPECTED_PAGES = 12


@query
def qa_page_count(spark: SparkSession, d: str) -> DataFrame:
    """Findings of the rules on whole documents where a number of pages is expected."""
    m = qa.metrics(A.delivered(spark, d), A.page_counts(spark, d))
    return qa.whole_document(m, Thresholds(expected_pages=EXPECTED_PAGES))


@query
def qa_metrics(spark: SparkSession, d: str) -> DataFrame:
    return qa.metrics(A.delivered(spark, d), A.page_counts(spark, d))


@query
def qa_report(spark: SparkSession, d: str) -> DataFrame:
    return qa.report(A.delivered(spark, d), A.page_counts(spark, d))


@query
def conversion_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs by configuration and status; repeated rows count once."""
    m = table(spark, d, "conversion_manifests").select("run_id", "document_id", "config_name", "status").distinct()
    return m.groupBy("config_name", "status").agg(F.count("*").alias("runs"), F.countDistinct("document_id").alias("documents"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


# ---- the same in SQL

SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
LEVELS = range(1, 10)
_case = lambda column, values, other: f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + f" ELSE '{other}' END"
_earlier = "PARTITION BY document_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

ITEMS = f"""one AS (SELECT id, any_value(document_id) AS document_id, any_value(reading_order) AS reading_order, any_value(text) AS text, any_value(heading_level) AS lev, any_value(provenance) AS provenance, any_value(metadata) AS metadata FROM canonical_elements WHERE id IS NOT NULL GROUP BY id),
typed AS (SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY reading_order, id) - 1 AS pos, lower(coalesce(metadata.docling_label, 'other')) AS label, {_case("lower(coalesce(metadata.docling_label, 'other'))", LABEL_TYPES, "other")} AS type0,
  regexp_replace(coalesce(text, ''), '^{SPACE}+|{SPACE}+$', '', 'g') AS text, CASE lower(metadata.docling_label) WHEN 'title' THEN 1 WHEN 'section_header' THEN greatest(1, coalesce(lev, metadata.traversal_level, 1)) END AS heading_level, coalesce(provenance[1].page, 1) AS id_page, provenance FROM one),
pages AS (SELECT document_id, text, unnest(provenance).page AS page FROM typed WHERE text <> ''),
rep AS (SELECT document_id, text, count(DISTINCT page) AS n_pages FROM pages GROUP BY ALL HAVING count(DISTINCT page) >= 3),
cls AS (SELECT t.*, CASE WHEN r.text IS NOT NULL AND regexp_matches(t.text, '(?i)page{SPACE}+[0-9]+') THEN 'footer' WHEN r.text IS NOT NULL AND type0 NOT IN ('header', 'footer') THEN 'header' ELSE type0 END AS type FROM typed t LEFT JOIN rep r USING (document_id, text)),
els AS (SELECT *, printf('%s_p%03d_%s_%03d', document_id, id_page, code, row_number() OVER (PARTITION BY document_id, id_page, code ORDER BY pos)) AS id FROM (SELECT *, {_case("type", TYPE_CODES, "obj")} AS code FROM cls)),
marks AS (SELECT *, type = 'heading' AND heading_level IS NOT NULL AS own, {", ".join(f"max(CASE WHEN type = 'heading' AND heading_level = {k} THEN pos END) OVER ({_earlier}) AS m{k}" for k in LEVELS)} FROM els),
ups AS (SELECT *, greatest({", ".join(f"CASE WHEN NOT own OR heading_level > {k} THEN coalesce(m{k}, -1) ELSE -1 END" for k in LEVELS)}) AS parent_pos FROM marks),
links AS (SELECT u.*, p.id AS parent_id FROM ups u LEFT JOIN els p ON p.document_id = u.document_id AND p.pos = u.parent_pos)"""
PATHS = f""", tops AS (SELECT id, parent_id, text FROM links WHERE own),
hp AS (SELECT id, text AS path FROM tops WHERE parent_id IS NULL UNION ALL SELECT t.id, hp.path || '{SEPARATOR}' || t.text FROM tops t JOIN hp ON t.parent_id = hp.id),
full_links AS (SELECT l.*, coalesce(hp.path, '') AS heading_path FROM links l LEFT JOIN hp ON l.parent_id = hp.id)"""
LATEST_TABLES = "lt AS (SELECT id, s.* FROM (SELECT id, max_by({'document_id': document_id, 'page': page, 'method': method, 'cells': cells, 'num_rows': num_rows, 'num_columns': num_columns}, coalesce(delivered_at, TIMESTAMP '1900-01-01')) AS s FROM extracted_tables WHERE id IS NOT NULL GROUP BY id))"
CELLS = f"""{LATEST_TABLES},
c AS (SELECT id, unnest(cells) AS c FROM lt),
agg AS (SELECT id, count(*) AS n_cells, count(*) FILTER (WHERE coalesce(c.is_header, false)) AS header_cells, count(*) FILTER (WHERE coalesce(c.row_span, 1) > 1 OR coalesce(c.column_span, 1) > 1) AS spanning_cells,
  coalesce(sum(greatest(1, coalesce(c.row_span, 1)) * greatest(1, coalesce(c.column_span, 1))) FILTER (WHERE regexp_replace(coalesce(c.text, ''), '^{SPACE}+|{SPACE}+$', '', 'g') <> ''), 0) AS area FROM c WHERE c IS NOT NULL GROUP BY id),
quality AS (SELECT lt.id, coalesce(method, '') AS method, coalesce(num_rows, 0) AS num_rows, coalesce(num_columns, 0) AS num_columns, CAST(coalesce(n_cells, 0) AS INT) AS n_cells,
  round(least(1.0::DOUBLE, coalesce(area, 0)::DOUBLE / greatest(1, coalesce(num_rows, 0) * coalesce(num_columns, 0))), 4) AS fill_ratio, CAST(coalesce(header_cells, 0) AS INT) AS header_cells, CAST(coalesce(spanning_cells, 0) AS INT) AS spanning_cells FROM lt LEFT JOIN agg USING (id))"""
PICTURES = """pics AS (SELECT id AS pos, any_value(document_id) AS doc_key, any_value(page) AS page, max_by(coalesce(kind, ''), coalesce(loaded_at, TIMESTAMP '1900-01-01')) AS kind, any_value(complexity) AS complexity, any_value(image_path) AS image_path, any_value(caption) AS caption, any_value(ocr_text) AS ocr_text, lower(any_value(image_hash)) AS image_hash FROM image_assets WHERE id IS NOT NULL GROUP BY id),
occ AS (SELECT *, printf('%s_p%03d_img_%03d', doc_key, coalesce(page, 1), row_number() OVER (PARTITION BY doc_key, coalesce(page, 1) ORDER BY pos)) AS occurrence_id FROM pics),
dup AS (SELECT *, first_value(occurrence_id) OVER w AS first_id, first_value(pos) OVER w AS first_pos FROM occ WHERE image_hash <> '' AND doc_key IS NOT NULL WINDOW w AS (PARTITION BY doc_key, image_hash ORDER BY pos))"""
DELIVERED = """e AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY reading_order NULLS FIRST, id NULLS FIRST, coalesce(loaded_at, TIMESTAMP '1900-01-01')) - 1 AS pos, provenance[1].page AS first_page FROM canonical_elements),
docs AS (SELECT id AS document_id, (max_by({'n': page_count}, coalesce(delivered_at, TIMESTAMP '1900-01-01'))).n AS page_count FROM canonical_documents WHERE id IS NOT NULL GROUP BY id)"""
FOREST = """WITH RECURSIVE n AS (SELECT document_id, id, nullif(max_by(coalesce(parent_id, ''), coalesce(loaded_at, TIMESTAMP '1900-01-01')), '') AS parent_id FROM canonical_elements WHERE id IS NOT NULL GROUP BY ALL),
dang AS (SELECT n.* FROM n LEFT JOIN n p ON p.document_id = n.document_id AND p.id = n.parent_id WHERE n.parent_id IS NOT NULL AND p.id IS NULL),
sound AS (SELECT document_id, id, id AS root_id, 0 AS depth, id AS path FROM (SELECT * FROM n WHERE parent_id IS NULL UNION ALL SELECT * FROM dang) UNION ALL SELECT n.document_id, n.id, s.root_id, s.depth + 1, s.path || '/' || n.id FROM n JOIN sound s ON n.document_id = s.document_id AND n.parent_id = s.id),
bad AS (SELECT n.document_id, n.id, n.parent_id FROM n ANTI JOIN sound s ON s.document_id = n.document_id AND s.id = n.id),
walk AS (SELECT document_id, id AS start, parent_id AS at FROM bad UNION SELECT w.document_id, w.start, b.parent_id FROM walk w JOIN bad b ON b.document_id = w.document_id AND b.id = w.at),
broken AS (SELECT document_id, id, CASE WHEN EXISTS (SELECT 1 FROM walk w WHERE w.document_id = bad.document_id AND w.start = bad.id AND w.at = bad.id) THEN 'cycle' ELSE 'below_cycle' END AS state FROM bad)"""
FINDINGS = {
    "qa_duplicate_id": "SELECT document_id, 'error' AS severity, 'duplicate_id' AS code, printf('ID occurs %d times', count(*)) AS message, id AS element_id, CAST(NULL AS INT) AS page FROM e GROUP BY document_id, id HAVING count(*) > 1",
    "qa_missing_parent": "SELECT document_id, 'error' AS severity, 'missing_parent' AS code, 'Parent reference does not exist' AS message, id AS element_id, first_page AS page FROM e WHERE parent_id <> '' AND NOT EXISTS (SELECT 1 FROM e p WHERE p.document_id = e.document_id AND p.id = e.parent_id)",
    "qa_reading_order": "SELECT document_id, 'error' AS severity, 'reading_order' AS code, 'Reading order is not strictly increasing' AS message, id AS element_id, first_page AS page FROM (SELECT *, lag(reading_order, 1, -1) OVER (PARTITION BY document_id ORDER BY pos) AS before FROM e) WHERE reading_order <= before",
    "qa_page_range": "SELECT document_id, 'error' AS severity, 'page_range' AS code, 'Element points outside the document' AS message, id AS element_id, p AS page FROM (SELECT document_id, id, unnest(provenance).page AS p FROM e) JOIN docs USING (document_id) WHERE p < 1 OR p > page_count",
    "qa_heading_jump": "SELECT document_id, 'warning' AS severity, 'heading_jump' AS code, printf('Heading jumps from H%d to H%d', before, heading_level) AS message, id AS element_id, first_page AS page FROM (SELECT *, lag(heading_level) OVER (PARTITION BY document_id ORDER BY pos) AS before FROM e WHERE heading_level IS NOT NULL) WHERE heading_level - before > 1",
}
METRICS = """m AS (SELECT document_id, any_value(page_count) AS pages, count(e.document_id) AS elements, coalesce(sum(length(coalesce(text, ''))) FILTER (WHERE e.document_id IS NOT NULL), 0) AS text_characters, count(heading_level) AS headings,
  count(*) FILTER (WHERE type = 'table') AS tables, count(*) FILTER (WHERE type = 'figure') AS figures, count(*) FILTER (WHERE type = 'list_item') AS lists FROM docs LEFT JOIN e USING (document_id) GROUP BY document_id)"""
LOW = "SELECT document_id, 'error' AS severity, 'low_text' AS code, printf('Only %d text characters extracted', CAST(text_characters AS BIGINT)) AS message, CAST(NULL AS VARCHAR) AS element_id, CAST(NULL AS INT) AS page FROM m WHERE text_characters < 100"
ALL_FINDINGS = " UNION ALL ".join([*FINDINGS.values(), LOW])


def _parts(text: str) -> list[str]:
    """A list split at the commas that stand in no brackets."""
    cuts, depth = [-1], 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            cuts.append(i)
    return [text[a + 1 : b].strip() for a, b in zip(cuts, [*cuts[1:], len(text)])]


def adjacency_sql(name: str, entity: str, ddl: str) -> tuple[list[str], list[str]]:
    """Tables (one per level of the schema) and selects that together are the adjacency table of a table's latest rows."""
    root = "struct<" + ",".join(x.replace(" ", ":", 1) for x in _parts(ddl)) + ">"
    row = "{" + ", ".join(f"'{x.split(':')[0]}': {x.split(':')[0]}" for x in _parts(root[7:-1])) + "}"
    tables = [f"{entity}_0 AS (SELECT id AS key, id AS node, NULL::VARCHAR AS parent, NULL::INT AS ordinal, max_by({row}, coalesce(delivered_at, TIMESTAMP '1900-01-01')) AS v FROM {name} WHERE id IS NOT NULL GROUP BY id)"]
    selects: list[str] = []

    def below(query: str, what: str, label: str) -> None:
        tables.append(f"{entity}_{len(tables)} AS ({query})")
        visit(f"{entity}_{len(tables) - 1}", what, label)

    def visit(level: str, what: str, label: str) -> None:
        outer, _, inner = what.removesuffix(">").partition("<")
        sort, scalar = {"struct": ("object", "NULL"), "map": ("object", "NULL"), "array": ("array", "NULL"), "timestamp": ("scalar", "epoch_us(v)")}.get(outer, ("scalar", "v"))
        selects.append(f"SELECT '{entity}' AS entity, key, node, parent, '{label}' AS label, ordinal, '{sort}' AS kind, CAST({scalar} AS VARCHAR) AS scalar FROM {level} WHERE v IS NOT NULL")
        if outer == "struct":
            for f, kind in (x.split(":", 1) for x in _parts(inner)):
                below(f"SELECT key, node || '.{f}' AS node, node AS parent, NULL::INT AS ordinal, v.{f} AS v FROM {level} WHERE v IS NOT NULL", kind.strip(), f)
        elif outer == "array":
            below(f"SELECT key, node || '[' || (n - 1) || ']' AS node, node AS parent, CAST(n - 1 AS INT) AS ordinal, v FROM (SELECT key, node, unnest(v) AS v, generate_subscripts(v, 1) AS n FROM {level} WHERE v IS NOT NULL)", inner, label)
        elif outer == "map":
            below(f"SELECT key, node || '{{' || e.key || '}}' AS node, node AS parent, NULL::INT AS ordinal, e.value AS v FROM (SELECT key, node, unnest(map_entries(v)) AS e FROM {level} WHERE v IS NOT NULL)", _parts(inner)[1], label)

    visit(f"{entity}_0", root, entity)
    return tables, selects


def _adjacency() -> str:
    both = [adjacency_sql("canonical_documents", "document", f"{DOCUMENT}, delivered_at timestamp"), adjacency_sql("extracted_tables", "table", f"{TABLE}, delivered_at timestamp")]
    return "WITH " + ",\n".join(t for tables, _ in both for t in tables) + "\n" + "\nUNION ALL ".join(s for _, selects in both for s in selects)


LATEST_MEMBERS = """WITH d AS (SELECT id, max_by({'e': elements}, coalesce(delivered_at, TIMESTAMP '1900-01-01')) AS s FROM canonical_documents WHERE id IS NOT NULL GROUP BY id),
el AS (SELECT id, unnest(s.e) AS e, generate_subscripts(s.e, 1) - 1 AS n FROM d)"""
_fields = lambda v, fields: ", ".join(f"CAST({v}.{f} AS VARCHAR) AS {f.replace('.', '_')}" for f in fields)


def oracle_sql() -> dict[str, str]:
    items, paths, cells, pics, dl = f"WITH {ITEMS}", f"WITH RECURSIVE {ITEMS}{PATHS}", f"WITH {CELLS}", f"WITH {PICTURES}", f"WITH {DELIVERED}"
    return {
        "p4_found": """WITH d AS (SELECT id, max_by({'e': elements}, coalesce(delivered_at, TIMESTAMP '1900-01-01')) AS s FROM canonical_documents WHERE id IS NOT NULL GROUP BY id),
t AS (SELECT id, max_by({'c': cells}, coalesce(delivered_at, TIMESTAMP '1900-01-01')) AS s FROM extracted_tables WHERE id IS NOT NULL GROUP BY id),
el AS (SELECT id, unnest(s.e) AS e, generate_subscripts(s.e, 1) - 1 AS n FROM d), ce AS (SELECT id, unnest(s.c) AS c, generate_subscripts(s.c, 1) - 1 AS n FROM t),
pr AS (SELECT e.id AS id, unnest(e.provenance) AS p, generate_subscripts(e.provenance, 1) - 1 AS n FROM el WHERE e IS NOT NULL)
SELECT DISTINCT 'element' AS relation, id AS parent_key, CAST(n AS INT) AS child_pos FROM el WHERE e IS NOT NULL
UNION SELECT 'provenance', id, CAST(n AS INT) FROM pr WHERE p IS NOT NULL UNION SELECT 'cell', id, CAST(n AS INT) FROM ce WHERE c IS NOT NULL""",
        "p4_adjacency": _adjacency(),
        "p4_elements": f"{LATEST_MEMBERS} SELECT id AS parent_key, CAST(n AS INT) AS child_pos, {_fields('e', ELEMENT_FIELDS)} FROM el WHERE e IS NOT NULL",
        "p4_provenance": f"{LATEST_MEMBERS}, p AS (SELECT id AS document_key, CAST(n AS INT) AS element_pos, unnest(e.provenance) AS p, generate_subscripts(e.provenance, 1) - 1 AS k FROM el WHERE e IS NOT NULL) SELECT document_key, element_pos, CAST(k AS INT) AS child_pos, {_fields('p', PROVENANCE_FIELDS)} FROM p WHERE p IS NOT NULL",
        "p4_cells": f"WITH {LATEST_TABLES}, c AS (SELECT id, unnest(cells) AS c, generate_subscripts(cells, 1) - 1 AS n FROM lt) SELECT id AS table_id, CAST(n AS INT) AS child_pos, c.text AS text, CAST(c.row AS VARCHAR) AS row, CAST(c.column AS VARCHAR) AS column, CAST(c.row_span AS VARCHAR) AS row_span, CAST(c.column_span AS VARCHAR) AS column_span, CAST(c.is_header AS VARCHAR) AS is_header FROM c WHERE c IS NOT NULL",
        "p7_found": f"""{FOREST}
SELECT id AS element_id, 'dangling' AS link_state FROM dang UNION ALL SELECT id, state FROM broken""",
        "p7_trees": f"""{FOREST}, parts AS (SELECT document_id, unnest(string_split(path, '/')) AS id FROM sound), below AS (SELECT document_id, id, count(*) - 1 AS n FROM parts GROUP BY ALL)
SELECT s.document_id, s.id AS element_id, s.root_id, s.depth, s.path, b.n AS n_descendants, CASE WHEN EXISTS (SELECT 1 FROM dang d WHERE d.document_id = s.document_id AND d.id = s.id) THEN 'dangling' END AS link_state FROM sound s JOIN below b ON b.document_id = s.document_id AND b.id = s.id
UNION ALL SELECT document_id, id, NULL, NULL, NULL, NULL, state FROM broken""",
        "p7_descendants": f"""{FOREST}, up AS (SELECT document_id, id, depth, string_split(path, '/') AS p FROM sound WHERE depth > 0), k AS (SELECT *, unnest(p) AS ancestor_id, generate_subscripts(p, 1) - 1 AS nth FROM up)
SELECT document_id, ancestor_id, id AS descendant_id, depth - nth AS distance FROM k WHERE nth < depth""",
        "inspect_documents": "SELECT doc_id, 'doc_' || substring(sha256(text), 1, 12) AS document_id, length(text) AS n_characters FROM documents",
        "element_type_counts": f"{items} SELECT type0 AS type, count(*) AS n FROM typed GROUP BY ALL",
        "heading_levels": f"{items} SELECT label, heading_level, count(*) AS n FROM typed GROUP BY ALL",
        "repeated_texts": f"{items} SELECT * FROM rep",
        "header_footer_reclass": f"{items} SELECT document_id, pos, label, type FROM cls",
        "canonical_elements": f"{items} SELECT document_id, pos, id, type, heading_level FROM els",
        "parent_links": f"{items} SELECT document_id, id, parent_id FROM links",
        "children_ids": f"{items} SELECT document_id, parent_id, row_number() OVER (PARTITION BY document_id, parent_id ORDER BY pos) - 1 AS child_pos, id AS child_id FROM links WHERE parent_id IS NOT NULL",
        "document_roots": f"{items} SELECT document_id, id FROM links WHERE parent_id IS NULL",
        "heading_path": f"{paths} SELECT document_id, id, heading_path FROM full_links",
        "chunks": f"{paths} SELECT 'chunk_' || id AS id, document_id, text, heading_path, provenance[1].page AS page, id AS element_ids, type FROM full_links WHERE text <> '' AND type NOT IN ('header', 'footer', 'caption')",
        "heading_outline": f"{items} SELECT document_id, n, repeat('  ', heading_level - 1) || substring(text, 1, 70) AS line FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY pos) AS n FROM typed WHERE heading_level IS NOT NULL) WHERE n <= 15",
        "bbox_invalid": "WITH one AS (SELECT id, any_value(document_id) AS document_id, any_value(provenance) AS p FROM canonical_elements WHERE id IS NOT NULL GROUP BY id), b AS (SELECT document_id, id, unnest(p).bbox AS b, generate_subscripts(p, 1) - 1 AS box_pos FROM one) SELECT document_id, id AS element_id, CAST(box_pos AS INT) AS box_pos FROM b WHERE (NOT isnan(b.right) AND NOT isnan(b.left) AND b.right < b.left) OR (NOT isnan(b.top) AND NOT isnan(b.bottom) AND b.top < b.bottom)",
        "tables_extracted": f"{cells} SELECT printf('%s_p%03d_tbl_%03d', lt.document_id, coalesce(page, 1), row_number() OVER (PARTITION BY lt.document_id, coalesce(page, 1) ORDER BY lt.id)) AS id, lt.document_id, coalesce(page, 1) AS page, q.num_rows, q.num_columns, q.n_cells FROM lt JOIN quality q USING (id)",
        "tables_cells": f"{cells}, ids AS (SELECT id, printf('%s_p%03d_tbl_%03d', document_id, coalesce(page, 1), row_number() OVER (PARTITION BY document_id, coalesce(page, 1) ORDER BY id)) AS table_id, list_filter(cells, lambda x: x IS NOT NULL) AS cells FROM lt), x AS (SELECT table_id, unnest(cells) AS c, generate_subscripts(cells, 1) - 1 AS n FROM ids) SELECT table_id, CAST(n AS INT) AS cell_pos, coalesce(c.text, '') AS text, coalesce(c.row, 0) AS row, coalesce(c.column, 0) AS column, greatest(1, coalesce(c.row_span, 1)) AS row_span, greatest(1, coalesce(c.column_span, 1)) AS column_span, coalesce(c.is_header, false) AS is_header FROM x",
        "table_quality": f"{cells} SELECT id, num_rows, num_columns, n_cells, fill_ratio, header_cells, spanning_cells FROM quality",
        "table_comparison": f"{cells} SELECT method AS run, id AS table_id, num_rows, num_columns, n_cells, fill_ratio, header_cells, spanning_cells FROM quality",
        "image_occurrences": f"{pics} SELECT pos AS image_id, occurrence_id, image_hash FROM occ WHERE image_hash <> ''",
        "image_dedup": f"{pics} SELECT d.occurrence_id, d.first_id, d.occurrence_id <> d.first_id AS is_duplicate, nullif(f.kind, '') AS kind, f.complexity, f.image_path, f.caption FROM dup d JOIN pics f ON f.pos = d.first_pos",
        "image_hash_summary": f"{pics} SELECT doc_key, count(*) AS total_occurrences, count(*) FILTER (WHERE occurrence_id = first_id) AS unique_images, count(*) FILTER (WHERE occurrence_id <> first_id) AS duplicate_occurrences FROM dup GROUP BY doc_key",
        "image_first_ids": f"{pics} SELECT doc_key, image_hash, first_id FROM dup WHERE occurrence_id = first_id",
        "image_kind": """WITH v AS (SELECT vec_id, len(list_filter(embedding, lambda x: abs(x) > 0.15))::DOUBLE / (len(embedding) + 1) AS e, vec_id * 37 % 9000 AS c, vec_id % 600 AS w, vec_id % 350 AS h FROM embeddings)
SELECT vec_id, CASE WHEN e > 0.22 AND c < 3000 THEN 'diagram/schematic' WHEN c > 5000 AND e > 0.08 THEN 'photo' WHEN h < 200 AND w < 400 THEN 'logo/icon' WHEN e > 0.14 THEN 'chart' ELSE 'unknown' END AS kind, CASE WHEN e > 0.16 OR c > 7000 THEN 'complex' ELSE 'simple' END AS complexity,
  round(least(0.95::DOUBLE, 0.5::DOUBLE + abs(e - 0.1::DOUBLE) + least(c, 8000)::DOUBLE / 40000), 3) AS confidence, printf('edge_density=%.3f;sampled_colors=%d', e, c) AS reasons FROM v""",
        "caption_prompts": f"""{pics}, h AS (SELECT occurrence_id, concat_ws(chr(10), 'Page: ' || page, CASE WHEN kind <> '' THEN 'Heuristic type guess: ' || kind END, CASE WHEN ocr_text <> '' THEN 'Nearby/embedded text: ' || substring(ocr_text, 1, 300) END) AS hints FROM dup WHERE occurrence_id = first_id AND kind <> 'logo/icon')
SELECT occurrence_id, 'Describe this figure.' || CASE WHEN hints <> '' THEN chr(10) || chr(10) || 'Context:' || chr(10) || hints ELSE '' END AS prompt FROM h""",
        **{name: f"{dl} {sql}" for name, sql in FINDINGS.items()},
        "qa_findings": f"{dl}, {METRICS} {ALL_FINDINGS}",
        "qa_page_count": f"{dl}, {METRICS} {LOW} UNION ALL SELECT document_id, 'error', 'page_count', 'Expected {EXPECTED_PAGES} pages, got ' || coalesce(CAST(pages AS VARCHAR), 'none'), NULL, NULL FROM m WHERE pages IS DISTINCT FROM {EXPECTED_PAGES}",
        "qa_metrics": f"{dl}, {METRICS} SELECT * FROM m",
        "qa_report": f"{dl}, {METRICS}, f AS ({ALL_FINDINGS}), n AS (SELECT document_id, count(*) FILTER (WHERE severity = 'error') AS errors, count(*) FILTER (WHERE severity = 'warning') AS warnings FROM f GROUP BY document_id) SELECT m.*, coalesce(errors, 0) AS errors, coalesce(warnings, 0) AS warnings, coalesce(errors, 0) = 0 AS passed FROM m LEFT JOIN n USING (document_id)",
        "conversion_runs": "WITH m AS (SELECT DISTINCT run_id, document_id, config_name, status FROM conversion_manifests) SELECT config_name, status, count(*) AS runs, count(DISTINCT document_id) AS documents FROM m GROUP BY ALL",
    }
