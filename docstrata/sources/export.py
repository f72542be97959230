"""Frames to files: parquet for storage, JSON lines and single-file artifacts for readers."""

from __future__ import annotations

import csv
import html
import io
import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.operators.elements import child_arrays


def store(df: DataFrame, path: str, key: str = "document_id") -> None:
    """Parquet sorted by the key within partitions of the range of the key, so row groups can be skipped."""
    order = [c for c in (key, "pos") if c in df.columns]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def json_lines(df: DataFrame, path: str) -> None:
    """One object a line, in document order within files, nulls written."""
    order = [c for c in ("document_id", "pos") if c in df.columns]
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    rows.drop("pos").write.mode("overwrite").option("ignoreNullFields", False).json(path)


def table_files(table: dict) -> dict[str, str]:
    """The JSON, HTML and CSV text of one table (a row as a dict)."""
    n, m = table.get("num_rows") or 0, table.get("num_columns") or 0
    grid = [["" for _ in range(m)] for _ in range(n)]
    for c in table.get("cells") or []:
        if c and 0 <= (c["row"] or 0) < n and 0 <= (c["column"] or 0) < m:
            grid[c["row"] or 0][c["column"] or 0] = c["text"] or ""
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(grid)
    body = "".join("<tr>" + "".join(f"<td>{html.escape(x)}</td>" for x in row) + "</tr>" for row in grid)
    return {"json": json.dumps(table, indent=2, ensure_ascii=False, default=str), "html": f"<table>{body}</table>", "csv": text.getvalue()}


def report_html(report: dict, findings: list[dict]) -> str:
    """A page of one document's metrics and findings; every value is escaped."""
    cell = lambda x: html.escape("" if x in (None, 0) else str(x))
    metric_rows = "".join(f"<tr><th>{html.escape(k)}</th><td>{html.escape(str(v))}</td></tr>" for k, v in report.items() if k not in ("document_id", "passed"))
    found = "".join("<tr>" + "".join(f"<td>{cell(f.get(k))}</td>" for k in ("severity", "code", "message", "page")) + "</tr>" for f in findings) or '<tr><td colspan="4">No findings</td></tr>'
    return (
        f"<!doctype html><meta charset='utf-8'><title>Quality report</title><h1>{html.escape(str(report['document_id']))}: {'passed' if report['passed'] else 'failed'}</h1>"
        f"<table>{metric_rows}</table><table><tr><th>Severity</th><th>Code</th><th>Message</th><th>Page</th></tr>{found}</table>"
    )


def _dump(value, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, ensure_ascii=False, default=str)


def document_json(documents: DataFrame, elements: DataFrame, document_id: str, path: str) -> None:
    """The tree of ONE document as schema.DOCUMENT: its elements with children, and its roots. Elements pass one by one."""
    mine = F.col("document_id") == document_id
    head = documents.where(F.col("id") == document_id).select("id", "source_name", "source_sha256", "page_count").first()
    rows = child_arrays(elements.where(mine)).orderBy("pos")
    roots = []
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(head.asDict() if head else {"id": document_id}, ensure_ascii=False)[:-1] + ', "elements": [')
        for n, r in enumerate(rows.toLocalIterator()):
            if r.parent_id is None:
                roots.append(r.id)
            element = {"id": r.id, "document_id": r.document_id, "type": r.type, "text": r.text, "reading_order": r.pos, "parent_id": r.parent_id, "children_ids": r.children_ids, "heading_level": r.heading_level, "provenance": [p.asDict(True) for p in r.provenance or []], "metadata": {"docling_label": r.label, "traversal_level": r.traversal_level}}
            f.write(("," if n else "") + "\n" + json.dumps(element, ensure_ascii=False))
        f.write('\n], "root_ids": ' + json.dumps(roots) + "}\n")


def table_artifacts(tables: DataFrame, document_id: str, folder: str) -> None:
    """JSON, HTML and CSV of each table of ONE document, and index.json with the paths."""
    os.makedirs(folder, exist_ok=True)
    index = []
    for row in tables.where(F.col("document_id") == document_id).orderBy("id").toLocalIterator():
        table = row.asDict(True) | {"files": {}}
        files = {}
        for kind, text in table_files(table).items():
            files[kind] = os.path.join(folder, f"{table['id']}.{kind}")
            with open(files[kind], "w", encoding="utf-8") as f:
                f.write(text)
        index.append(table | {"files": files})
    _dump(index, os.path.join(folder, "index.json"))


def picture_artifacts(pictures: DataFrame, document_id: str, folder: str) -> None:
    """ONE document's pictures: the bytes and a sidecar of each first occurrence, index.json and hashes.json. pictures:
    images.described() rows with content."""
    os.makedirs(folder, exist_ok=True)
    index, first = [], {}
    for row in pictures.where(F.col("doc_key") == document_id).orderBy("pos").toLocalIterator():
        base = os.path.join(folder, f"{document_id}_img_{row.image_hash[:12]}_{row.complexity}")
        asset = {
            "id": row.occurrence_id, "document_id": document_id, "page": row.id_page, "kind": row.kind, "complexity": row.complexity, "classification_confidence": row.confidence, "classification_reasons": row.reasons,
            "source_element_id": row.occurrence_id, "image_path": f"{base}.png", "metadata_path": f"{base}.json", "caption": row.caption, "bbox": row.bbox.asDict() if row.bbox else None, "ocr_text": row.ocr_text or "", "image_hash": row.image_hash, "is_duplicate": row.is_duplicate,
        }
        if not row.is_duplicate:
            first[row.image_hash] = row.occurrence_id
            with open(f"{base}.png", "wb") as f:
                f.write(row.content)
            _dump(asset, f"{base}.json")
        index.append(asset)
    _dump(index, os.path.join(folder, "index.json"))
    _dump({"total_occurrences": len(index), "unique_images": len(first), "duplicate_occurrences": len(index) - len(first), "hash_to_image_id": first}, os.path.join(folder, "hashes.json"))


def manifest(conversion: dict, document_id: str, folder: str) -> None:
    """manifest.json: the facts of the conversion and the files of the document."""
    facts = {k: v for k, v in conversion.items() if k not in ("items", "tables", "pictures", "raw", "doc_key")}
    facts["config"] = json.loads(facts["config"]) if facts.get("config") else None
    os.makedirs(os.path.join(folder, "raw"), exist_ok=True)
    for name, text in (conversion.get("raw") or {}).items():
        with open(os.path.join(folder, "raw", os.path.basename(name)), "w", encoding="utf-8") as f:
            f.write(text or "")
    _dump(facts, os.path.join(folder, "raw", "conversion.json"))
    files = {"canonical": "document.json", "elements": "elements.jsonl", "chunks": "chunks.jsonl", "tables": "tables/index.json", "images": "images/index.json", "qa": "qa/report.html"}
    _dump(facts | {"document_id": document_id, "output": folder, "files": files}, os.path.join(folder, "manifest.json"))


def document_artifacts(elements: DataFrame, chunks: DataFrame, report: DataFrame, findings: DataFrame, document_id: str, folder: str) -> None:
    """The files of ONE document for people to read. Rows come through an iterator, not at once."""
    os.makedirs(os.path.join(folder, "qa"), exist_ok=True)
    mine = F.col("document_id") == document_id
    for name, df in (("elements", elements), ("chunks", chunks)):
        with open(os.path.join(folder, f"{name}.jsonl"), "w", encoding="utf-8") as f:
            for row in df.where(mine).orderBy("pos").drop("pos").toLocalIterator():
                f.write(json.dumps(row.asDict(True), ensure_ascii=False, default=str) + "\n")
    one = report.where(mine).first()
    found = [r.asDict() for r in findings.where(mine).toLocalIterator()]
    if one is not None:
        with open(os.path.join(folder, "qa", "report.json"), "w", encoding="utf-8") as f:
            json.dump(one.asDict() | {"findings": found}, f, indent=2, default=str)
        with open(os.path.join(folder, "qa", "report.html"), "w", encoding="utf-8") as f:
            f.write(report_html(one.asDict(), found))
