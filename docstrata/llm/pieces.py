"""Splitting oversized items at natural boundaries (problem 6): lexical cohesion.

Items are single texts over ELEMENT_LIMIT characters and sections over SECTION_LIMIT. Inside an
oversized item, blocks of sentences slide over each gap between sentences; the similarity of
the words left and right of a gap is its score, and a gap's depth is how far its score lies
below the peaks on both sides. Of the gaps that a piece may end at, the deepest valley in the
window of sizes is chosen, then pieces get the overlap. Without a sentence boundary in the
window a line end, then a space, then the limit itself is taken.

Sections need the last heading before each row. A document may hold a tenth of all rows, so
its rows are cut into blocks of reading order: the last heading is found inside each block,
and a row per block carries it over blocks. Only oversized sections are put together, and one
that spans blocks is cut block by block (a block's end is an element's end, so a natural
boundary; the overlap reaches over it), so no section becomes one task.

Results: null and empty texts have no size; of rows with one id the latest by loaded_at
counts; rows before a document's first heading are in no section. The pieces of an item, each
without its overlap, concatenate to the item's text (a section's texts each followed by a line feed).
Sizes are code points; a piece with its overlap stays within the limit. Rows with a null
reading_order are in no section.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docstrata.runtime import checkpoint, shuffle_partitions

ELEMENT_LIMIT = 1200
SECTION_LIMIT = 5000
OVERLAP = 100
BLOCK_ROWS = 4096
#: Sentences on each side of a gap, and the smallest part of the limit that a piece fills.
SIDE = 4
FILL = 0.5

SENTENCE = re.compile(r"(?<=[.!?…。！？])[\"'”’)\]]*\s+|\n+")
WORD = re.compile(r"[^\W\d_]{2,}")


def depths(sentences: list[Counter]) -> list[float]:
    """Depth of the similarity valley at each gap i (between sentences i and i + 1)."""
    score = []
    for i in range(len(sentences) - 1):
        left, right = Counter(), Counter()
        for c in sentences[max(0, i - SIDE + 1) : i + 1]:
            left.update(c)
        for c in sentences[i + 1 : i + 1 + SIDE]:
            right.update(c)
        norm = (sum(v * v for v in left.values()) * sum(v * v for v in right.values())) ** 0.5
        score.append(sum(v * right[w] for w, v in left.items()) / norm if norm else 0.0)
    # The peak on a side is reached by climbing from gap to gap as long as it doesn't go down.
    left, right = list(score), list(score)
    for i in range(1, len(score)):
        if score[i - 1] >= score[i]:
            left[i] = left[i - 1]
    for i in range(len(score) - 2, -1, -1):
        if score[i + 1] >= score[i]:
            right[i] = right[i + 1]
    return [a - s + b - s for a, s, b in zip(left, score, right)]


def cut(text: str, limit: int, overlap: int = OVERLAP, lead: int = 0) -> list[tuple[int, int, int]]:
    """(start of the overlap, start, end) of each piece; starts and ends cover the text. lead: characters that
    the first piece gets before its own from elsewhere."""
    if len(text) + lead <= limit:
        return [(0, 0, len(text))]
    bounds = [m.end() for m in SENTENCE.finditer(text)]
    ends = sorted({*bounds, len(text)})
    words = [Counter(w.lower() for w in WORD.findall(text[a:b])) for a, b in zip([0, *ends], ends)]
    depth = dict(zip(ends, depths(words)))
    lines = [m.end() for m in re.finditer(r"\n", text)]
    out, at = [], 0
    while at < len(text):
        back = at
        if at:
            back = max(at - overlap, 0)
            space = text.find(" ", back, at)  # the overlap begins with a whole word
            back = space + 1 if 0 <= space < at - 1 else back
        most = limit - ((at - back) if at else lead)
        if len(text) - at <= most:
            out.append((back, at, len(text)))
            break
        near = ends[bisect_right(ends, at) : bisect_right(ends, at + most)]
        window = near[bisect_left(near, at + FILL * most) :] or near[-1:]
        if window:
            best = max(window, key=lambda e: (round(depth.get(e, 0.0), 9), e))
        else:
            k = bisect_right(lines, at + most)
            line = lines[k - 1] if k and lines[k - 1] > at else 0
            best = line or text.rfind(" ", at + 1, at + most) + 1 or at + most
            if best <= at:
                best = at + most
        out.append((back, at, best))
        at = best
    return out


PIECES = "item_kind string, item_id string, stretch bigint, piece int, overlap int, text string"


def _cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("item_kind", "item_id", "stretch", "piece", "overlap", "text")
    types = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string())
    for batch in batches:
        rows: dict[str, list] = {k: [] for k in names}
        for kind, item, limit, stretch, lead, text in zip(*(c.to_pylist() for c in batch.columns)):
            # lead: the end of the text before, for the overlap of the first piece
            parts = cut(text, limit, lead=len(lead))
            for i, (back, a, b) in enumerate(parts):
                head = lead if not i else text[back:a]
                for k, v in zip(names, (kind, item, stretch, i, len(head), head + text[a:b])):
                    rows[k].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], names=list(names))


def latest_rows(elements: DataFrame) -> DataFrame:
    """Each id once, without its text: document_id, id, reading_order, heading, size, loaded_at."""
    row = F.struct(F.col("loaded_at").alias("at"), F.length(F.coalesce("text", F.lit(""))).alias("size"), F.col("reading_order").alias("pos"), F.col("heading_level").isNotNull().alias("heading"), F.coalesce("document_id", F.lit("")).alias("document_id"))
    return elements.where(F.col("id").isNotNull()).select("id", row.alias("r")).groupBy("id").agg(F.max("r").alias("r")).select("id", "r.*")


def sections(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds section_id (the id of the last heading up to the row) and drops rows without one."""
    placed = rows.where(F.col("pos").isNotNull()).withColumn("block", F.floor(F.col("pos") / block_rows))
    inside = Window.partitionBy("document_id", "block").orderBy("pos", "id")
    own = placed.withColumn("own", F.last(F.when(F.col("heading"), F.col("id")), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    last = placed.where("heading").groupBy("document_id", "block").agg(F.max_by("id", F.struct("pos", "id")).alias("final"))
    blocks = placed.select("document_id", "block").distinct().join(last, ["document_id", "block"], "left")
    before = Window.partitionBy("document_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("document_id", "block", F.last("final", ignorenulls=True).over(before).alias("carried"))
    return own.join(carried, ["document_id", "block"]).withColumn("section_id", F.coalesce("own", "carried")).where(F.col("section_id").isNotNull()).drop("own", "carried")


def oversized(elements: DataFrame) -> DataFrame:
    """item_kind, item_id, limit, text of everything over its limit."""
    texts = elements.where(F.col("id").isNotNull()).select("id", F.col("loaded_at").alias("at"), F.length(F.coalesce("text", F.lit(""))).alias("size"), "text")
    rows = checkpoint(latest_rows(elements))
    long = rows.where(F.col("size") > ELEMENT_LIMIT)
    alone = texts.where(F.length("text") > ELEMENT_LIMIT).groupBy("id").agg(F.max_by("text", F.struct("at", "size", "text")).alias("text")).join(long.select("id"), "id", "left_semi")
    placed = sections(rows)
    sized = placed.groupBy("section_id").agg(F.sum("size").alias("total")).where(F.col("total") > SECTION_LIMIT)
    members = placed.join(sized.select("section_id"), "section_id", "left_semi").where(F.col("size") > 0).select("section_id", "block", "id", "pos")
    body = texts.where(F.length("text") > 0).join(members, "id").groupBy("section_id", "block", "id", "pos").agg(F.max_by("text", F.struct("at", "size", "text")).alias("text"))
    stretch = body.groupBy("section_id", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "id", "text"))).alias("t"))
    joined = F.concat(F.array_join(F.transform("t", lambda x: x["text"]), "\n"), F.lit("\n"))
    order = Window.partitionBy("section_id").orderBy("block")
    tails = stretch.select("section_id", "block", F.right(joined, F.lit(OVERLAP)).alias("tail")).withColumn("lead", F.coalesce(F.lag("tail").over(order), F.lit(""))).drop("tail")
    whole = stretch.select("section_id", "block", joined.alias("text")).join(tails, ["section_id", "block"])
    one = alone.select(F.lit("element").alias("item_kind"), F.col("id").alias("item_id"), F.lit(ELEMENT_LIMIT).alias("limit"), F.lit(0).cast("bigint").alias("stretch"), F.lit("").alias("lead"), "text")
    return one.unionAll(whole.select(F.lit("section"), "section_id", F.lit(SECTION_LIMIT), F.col("block"), "lead", "text"))


def _spread(items: DataFrame) -> DataFrame:
    """Cutting is work by the character, so the items are dealt to more tasks than their bytes would get."""
    return items.repartition(4 * shuffle_partitions(items.sparkSession), "item_id", "stretch")


def pieces(elements: DataFrame) -> DataFrame:
    """item_kind, item_id, piece (0-based), n_pieces, overlap (characters repeated), text."""
    cut_up = checkpoint(_spread(oversized(elements)).mapInArrow(_cut_all, PIECES))
    order = Window.partitionBy("item_kind", "item_id").orderBy("stretch")
    n = cut_up.groupBy("item_kind", "item_id", "stretch").agg(F.count("*").alias("n"))
    n = n.select("item_kind", "item_id", "stretch", (F.sum("n").over(order) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy("item_kind", "item_id")).alias("n_pieces"))
    return cut_up.join(n, ["item_kind", "item_id", "stretch"]).select("item_kind", "item_id", (F.col("before") + F.col("piece")).alias("piece"), "n_pieces", "overlap", "text")


def found(elements: DataFrame) -> DataFrame:
    """item_kind, item_id of the items cut into more than one piece."""
    cut_up = _spread(oversized(elements)).mapInArrow(_cut_all, PIECES)
    return cut_up.groupBy("item_kind", "item_id").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("item_kind", "item_id")
