"""Extracted tables: ids, cells, structural quality and comparison of runs.

Results for dirty input: a table without cells (null or empty) has zero counts and ratio 0;
null cells are no cells; null spans count as 1, spans of 0 or less as 1; null flags are false;
blank text doesn't occupy. Null sizes count as 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstrata.functions import scalars as S
from docstrata.operators.scans import with_ordinal


def extract(raw: DataFrame, method: str) -> DataFrame:
    """raw: doc_key, pos, prov, cells (array of start_row, end_row, start_col, end_col, text,
    column_header, row_header), num_rows, num_cols. Ids count tables per page."""
    page = F.coalesce(S.first_page(F.col("prov")), F.lit(1))
    ranked = with_ordinal(raw.withColumn("page", page), ["doc_key", "page"], "pos", [], "n")

    def cell(c: Column) -> Column:
        row, column = F.coalesce(c["start_row"], F.lit(0)), F.coalesce(c["start_col"], F.lit(0))
        return F.struct(
            F.coalesce(c["text"], F.lit("")).alias("text"), row.alias("row"), column.alias("column"),
            F.greatest(F.lit(1), c["end_row"] - row).alias("row_span"), F.greatest(F.lit(1), c["end_col"] - column).alias("column_span"),
            (F.coalesce(c["column_header"], F.lit(False)) | F.coalesce(c["row_header"], F.lit(False))).alias("is_header"),
        )

    ident = S.element_id(F.col("doc_key"), F.col("page"), F.lit("tbl"), F.col("n"))
    return ranked.select(
        ident.alias("id"), F.col("doc_key").alias("document_id"), "page", F.lit(method).alias("method"), F.lit(None).cast("string").alias("caption"),
        F.try_element_at("prov", F.lit(1))["bbox"].alias("bbox"), F.transform(F.filter("cells", lambda c: c.isNotNull()), cell).alias("cells"),
        F.coalesce("num_rows", F.lit(0)).alias("num_rows"), F.coalesce("num_cols", F.lit(0)).alias("num_columns"), ident.alias("source_element_id"),
    )


def quality(tables: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """keys, num_rows, num_columns, n_cells, fill_ratio, header_cells, spanning_cells; no shuffle."""
    cells = F.filter(F.coalesce("cells", F.array().cast(tables.schema["cells"].dataType)), lambda c: c.isNotNull())
    span = lambda c, name: F.greatest(F.lit(1), c[name])  # noqa: E731  (nulls are passed over)
    area = F.aggregate(F.filter("_c", lambda c: S.strip(c["text"]) != ""), F.lit(0).cast("bigint"), lambda a, c: a + span(c, "row_span") * span(c, "column_span"))
    return tables.withColumn("_c", cells).select(
        *keys, F.coalesce("num_rows", F.lit(0)).alias("num_rows"), F.coalesce("num_columns", F.lit(0)).alias("num_columns"), F.size("_c").alias("n_cells"),
        S.fill_ratio(area, F.col("num_rows"), F.col("num_columns")).alias("fill_ratio"),
        F.size(F.filter("_c", lambda c: F.coalesce(c["is_header"], F.lit(False)))).alias("header_cells"),
        F.size(F.filter("_c", lambda c: (span(c, "row_span") > 1) | (span(c, "column_span") > 1))).alias("spanning_cells"),
    )


def compare(runs: dict[str, DataFrame]) -> DataFrame:
    """Quality of the tables of several runs, one below the other; run is the given name."""
    parts = [quality(t).select(F.lit(name).alias("run"), F.col("id").alias("table_id"), "num_rows", "num_columns", "n_cells", "fill_ratio", "header_cells", "spanning_cells") for name, t in runs.items()]
    return reduce(DataFrame.unionByName, parts)
