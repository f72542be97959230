"""Column expressions of the document model."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from docstrata.schema import LABEL_TYPES, TYPE_CODES

#: Unicode white space and the four separators that Python counts to it.
SPACE = r"[\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
PAGE_NUMBER = rf"(?iU)page{SPACE}+\d+"


def _lookup(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain(*values.items())])


def strip(c: Column) -> Column:
    """Null to '' and white space off both ends."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), rf"^{SPACE}+|{SPACE}+$", "")


def label(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit("other")))


def element_type(lab: Column) -> Column:
    return F.coalesce(_lookup(LABEL_TYPES)[lab], F.lit("other"))


def type_code(kind: Column) -> Column:
    return F.coalesce(_lookup(TYPE_CODES)[kind], F.lit("obj"))


def heading_level(lab: Column, level: Column, depth: Column) -> Column:
    """1 for titles; for section headers the level, else the depth, at least 1; else null."""
    return F.when(lab == "title", F.lit(1)).when(lab == "section_header", F.greatest(F.lit(1), F.coalesce(level, depth, F.lit(1))))


def first_page(prov: Column) -> Column:
    """Page of the first provenance, or null."""
    return F.try_element_at(prov, F.lit(1))["page"]


def document_id(content: Column) -> Column:
    return F.concat(F.lit("doc_"), F.substring(F.sha2(content, 256), 1, 12))


def element_id(doc: Column, page: Column, code: Column, ordinal: Column) -> Column:
    return F.format_string("%s_p%03d_%s_%03d", doc, page, code, ordinal)


def bad_box(box: Column) -> Column:
    """Right of left, or bottom above top; comparisons with NaN are false. Null boxes aren't bad."""
    def less(a: str, b: str) -> Column:
        return ~F.isnan(box[a]) & ~F.isnan(box[b]) & (box[a] < box[b])

    return F.coalesce(less("right", "left"), F.lit(False)) | F.coalesce(less("top", "bottom"), F.lit(False))


def fill_ratio(occupied: Column, rows: Column, columns: Column) -> Column:
    return F.round(F.least(F.lit(1.0), occupied / F.greatest(F.lit(1), F.coalesce(rows, F.lit(0)) * F.coalesce(columns, F.lit(0)))), 4)


def image_kind(edge: Column, colors: Column, width: Column, height: Column) -> Column:
    return (
        F.when((edge > 0.22) & (colors < 3000), "diagram/schematic")
        .when((colors > 5000) & (edge > 0.08), "photo")
        .when((height < 200) & (width < 400), "logo/icon")
        .when(edge > 0.14, "chart")
        .otherwise("unknown")
    )


def image_complexity(edge: Column, colors: Column) -> Column:
    return F.when((edge > 0.16) | (colors > 7000), "complex").otherwise("simple")


def image_confidence(edge: Column, colors: Column) -> Column:
    return F.round(F.least(F.lit(0.95), 0.5 + F.abs(edge - 0.1) + F.least(colors, F.lit(8000)) / 40000), 3)


def image_reasons(edge: Column, colors: Column) -> Column:
    return F.array(F.format_string("edge_density=%.3f", edge), F.format_string("sampled_colors=%d", colors))


def caption_prompt(page: Column, section: Column, kind: Column, ocr: Column) -> Column:
    """The request for a caption, with what is known of the picture; empty values are left out."""
    def line(name: str, value: Column) -> Column:
        return F.when(F.length(value) > 0, F.concat(F.lit(name), value))

    hints = F.concat_ws("\n", F.when(page.isNotNull(), F.concat(F.lit("Page: "), page.cast("string"))), line("Section: ", section), line("Heuristic type guess: ", kind), line("Nearby/embedded text: ", F.substring(ocr, 1, 300)))
    return F.concat(F.lit("Describe this figure."), F.when(hints != "", F.concat(F.lit("\n\nContext:\n"), hints)).otherwise(""))
