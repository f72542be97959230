"""Pictures: ids, duplicates by content, kinds and the caption hook.

Results for dirty input: a picture without content keeps its place in the count of its page and
is dropped afterwards; a null or empty hash is a picture without content. The first picture of
a hash in a document gives kind, paths and caption to its duplicates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docstrata.functions import scalars as S
from docstrata.operators.scans import with_ordinal

SHARED = ("kind", "complexity", "classification_confidence", "image_path", "caption")


def occurrences(raw: DataFrame) -> DataFrame:
    """raw: doc_key, pos, page, image_hash and any further columns. Adds id; ordinals count before
    pictures without content are dropped."""
    ranked = with_ordinal(raw.withColumn("id_page", F.coalesce("page", F.lit(1))), ["doc_key", "id_page"], "pos", [], "n")
    ident = S.element_id(F.col("doc_key"), F.col("id_page"), F.lit("img"), F.col("n"))
    return ranked.withColumn("occurrence_id", ident).where(F.length("image_hash") > 0).drop("n")


def deduplicated(found: DataFrame) -> DataFrame:
    """Adds is_duplicate and first_id. The first of a hash comes from an aggregate, not a window, so
    a logo on a third of all pages is no task of its own."""
    first = found.groupBy("doc_key", "image_hash").agg(F.min(F.struct("pos", "occurrence_id")).alias("f"))
    first = first.select("doc_key", "image_hash", F.col("f.occurrence_id").alias("first_id"))
    return found.join(first, ["doc_key", "image_hash"]).withColumn("is_duplicate", F.col("occurrence_id") != F.col("first_id"))


def inherited(found: DataFrame, columns: tuple[str, ...] = SHARED) -> DataFrame:
    """deduplicated() with the named columns of the first occurrence on every duplicate."""
    rows = deduplicated(found)
    kept = rows.where(~F.col("is_duplicate")).select("doc_key", F.col("occurrence_id").alias("first_id"), *[F.col(c).alias(f"_{c}") for c in columns])
    return rows.drop(*columns).join(kept, ["doc_key", "first_id"], "left").withColumnsRenamed({f"_{c}": c for c in columns})


def hash_summary(rows: DataFrame) -> DataFrame:
    """Per document: occurrences, unique images, duplicates."""
    return rows.groupBy("doc_key").agg(F.count("*").alias("total_occurrences"), F.count_if(~F.col("is_duplicate")).alias("unique_images"), F.count_if("is_duplicate").alias("duplicate_occurrences"))


def classified(stats: DataFrame) -> DataFrame:
    """Adds kind, complexity, confidence and reasons from edge_density, color_count, width, height."""
    e, c = F.col("edge_density"), F.col("color_count")
    return stats.withColumns({"kind": S.image_kind(e, c, F.col("width"), F.col("height")), "complexity": S.image_complexity(e, c), "confidence": S.image_confidence(e, c), "reasons": S.image_reasons(e, c)})


def pixel_statistics(gray: np.ndarray, rgb: np.ndarray) -> tuple[float, int]:
    """Share of strong edges (Laplacian of eight neighbours over 40, borders as they are) and number of
    colours in a sample of at most 256 x 256 pixels."""
    g = gray.astype(np.int32)
    edges = g.copy()
    if min(g.shape) > 2:
        around = sum(np.roll(np.roll(g, a, 0), b, 1) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b)
        edges[1:-1, 1:-1] = np.clip(8 * g - around, 0, 255)[1:-1, 1:-1]
    h, w = rgb.shape[:2]
    sample = rgb[np.linspace(0, h - 1, min(256, h)).astype(int)][:, np.linspace(0, w - 1, min(256, w)).astype(int)]
    return float((edges > 40).mean()), len(np.unique(sample.reshape(-1, 3), axis=0))


def described(found: DataFrame) -> DataFrame:
    """deduplicated() plus kind, complexity, confidence and reasons of pictures with rgb (three bytes a pixel, by rows), width
    and height; computed once per first occurrence and shared by its duplicates. Without pixels: 'unknown', no reasons."""
    rows = deduplicated(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            edges, colors = [], []
            for raw, w, h in zip(*(c.to_pylist() for c in b.columns[1:])):
                whole = raw is not None and w and h and len(raw) == 3 * w * h
                rgb = np.frombuffer(raw, np.uint8).reshape(h, w, 3) if whole else None
                e, c = pixel_statistics((rgb @ np.array([0.299, 0.587, 0.114])).astype(np.uint8), rgb) if whole else (None, None)
                edges.append(e)
                colors.append(c)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(edges, pa.float64()), pa.array(colors, pa.int32())], names=["first_id", "width", "height", "edge_density", "color_count"])

    firsts = rows.where(~F.col("is_duplicate")).select(F.col("occurrence_id").alias("first_id"), "rgb", "width", "height")
    known = classified(firsts.mapInArrow(run, "first_id string, width int, height int, edge_density double, color_count int"))
    seen = F.col("edge_density").isNotNull()
    known = known.select("first_id", F.when(seen, F.col("kind")).otherwise("unknown").alias("kind"), F.when(seen, F.col("complexity")).otherwise("simple").alias("complexity"), F.when(seen, F.col("confidence")).alias("confidence"), F.when(seen, F.col("reasons")).alias("reasons"))
    return rows.join(known, "first_id", "left")


def first_ids(rows: DataFrame) -> DataFrame:
    """doc_key, image_hash, first_id: the map from hashes to the first picture, as rows."""
    return rows.where(~F.col("is_duplicate")).select("doc_key", "image_hash", "first_id")


#: The texts that stand for a missing answer.
NO_CANDIDATES, EMPTY_ANSWER = "[caption generation returned no candidates]", "[caption generation returned empty response]"
ANSWER = "candidates array<struct<content:struct<parts:array<struct<text:string>>>>>"


def answer_text(answer: Column) -> Column:
    """The text of a caption service's JSON answer: the parts of its first candidate, or a fixed text without any."""
    first = F.try_element_at(F.from_json(answer, ANSWER)["candidates"], F.lit(1))
    text = S.strip(F.array_join(F.transform(first["content"]["parts"], lambda p: F.coalesce(p["text"], F.lit(""))), ""))
    return F.when(first.isNull(), NO_CANDIDATES).when(F.coalesce(text, F.lit("")) == "", EMPTY_ANSWER).otherwise(text)


def payload(content: Column) -> Column:
    """A picture's bytes as a service takes them."""
    return F.base64(content)


FAILED = "[caption unavailable]"


def captioned(rows: DataFrame, hook: Callable[[str, str], str] | None, skip_kinds: tuple[str, ...] = ("logo/icon",)) -> DataFrame:
    """rows of deduplicated() with kind and prompt. The hook gets image_path and prompt once per first
    occurrence that isn't skipped; a failing hook gives a fixed text and an error flag."""
    firsts = rows.where(~F.col("is_duplicate") & ~F.coalesce(F.col("kind").isin(*skip_kinds), F.lit(False))).select("doc_key", "image_hash", "image_path", "prompt")
    if hook is None:
        return rows.withColumn("caption", F.lit(None).cast("string")).withColumn("caption_failed", F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, bad = [], []
            for path, prompt in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                try:
                    out.append(hook(path, prompt))
                    bad.append(False)
                except Exception:
                    out.append(FAILED)
                    bad.append(True)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(bad)], names=["doc_key", "image_hash", "caption", "caption_failed"])

    made = firsts.mapInArrow(run, "doc_key string, image_hash string, caption string, caption_failed boolean")
    return rows.drop("caption").join(made, ["doc_key", "image_hash"], "left")
