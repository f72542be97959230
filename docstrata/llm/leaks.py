"""Evaluation passages in training text (problem 9): winnowing.

Of every window of WINDOW consecutive k-gram hashes the smallest is a fingerprint. Two
texts that share WINDOW + K - 1 = 13 words in a row share a window, hence a fingerprint, so
the join of corpus and test fingerprints misses no such span. Each hit is then extended
word by word to both sides and kept when 13 words in a row agree.

The test items are the query set: their fingerprints are made once and go to the executors in blocks
of at most BLOCK_WORDS words, each block against all documents. Of several blocks one is matched and its
hits are written before the next is read, so what is held and sent at once is bounded however many
items there are. The corpus is scanned, never shuffled; an item that leaked
into a third of all documents costs each of those documents its own hit and no more.

Results: words are runs of letters and digits in lower case; a backslash and the letters
after it are no words; comments are text. Items and documents of fewer than 13 words (null
and empty texts too) give no row. Rows are distinct. Null ids are kept as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.llm import vec
from docstrata.runtime import checkpoint

SPAN = 13
K = 7
WINDOW = SPAN - K + 1
BLOCK_WORDS = 2_000_000
CHUNK_ROWS = 1000


def fingerprints(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed k-gram hashes of all texts of a batch and the index of their first words."""
    g, at = vec.ngrams(h, row, K)
    if len(g) < WINDOW:
        return g[:0], at[:0]
    whole = row[at[: len(g) - WINDOW + 1]] == row[at[WINDOW - 1 :]]
    view = np.lib.stride_tricks.sliding_window_view(g, WINDOW)
    pick = np.unique((np.arange(len(view)) + view.argmin(axis=1))[whole])
    return g[pick], at[pick]


class Items:
    """Word hashes of the test items of a block and their fingerprints, sorted by hash."""

    def __init__(self, ids: list, h: np.ndarray, row: np.ndarray, fp: np.ndarray, at: np.ndarray):
        self.ids, self.h, self.row, self.fp, self.at = ids, h, row, fp, at

    @classmethod
    def of(cls, ids: list, texts: pa.Array) -> Items:
        cp, starts = vec.codepoints(texts)
        h, row, _, _ = vec.words(cp, starts, commands=True)
        fp, at = fingerprints(h, row)
        order = np.argsort(fp, kind="stable")
        return cls(ids, h, row.astype(np.int32), fp[order], at[order])

    def matches(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text index, item index) of texts that share SPAN words in a row with an item."""
        fp, at = fingerprints(h, row)
        lo, hi = np.searchsorted(self.fp, fp, "left"), np.searchsorted(self.fp, fp, "right")
        n = hi - lo
        hit = np.flatnonzero(n)
        p = np.repeat(at[hit], n[hit])
        k = np.repeat(lo[hit] - np.concatenate([[0], np.cumsum(n[hit])[:-1]]), n[hit]) + np.arange(int(n[hit].sum()))
        q = self.at[k.astype(np.int64)]
        run = np.full(len(p), K)
        for sign, first in ((-1, -1), (1, K)):
            going = np.ones(len(p), bool)
            for t in range(SPAN - K):
                a, b = p + first + sign * t, q + first + sign * t
                inside = (a >= 0) & (a < len(h)) & (b >= 0) & (b < len(self.h))
                a, b = np.where(inside, a, 0), np.where(inside, b, 0)
                going &= inside & (row[a] == row[p]) & (self.row[b] == self.row[q]) & (h[a] == self.h[b])
                run += going
        good = run >= SPAN
        pairs = np.unique(np.stack([row[p[good]], self.row[q[good]]], 1), axis=0)
        return pairs[:, 0], pairs[:, 1]


def _scan(shared, schema_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        item_ids = pa.array(items.ids, pa.int64())
        for whole in batches:
            for i in range(0, whole.num_rows, CHUNK_ROWS):
                batch = whole.slice(i, CHUNK_ROWS)
                cp, starts = vec.codepoints(batch.column(1))
                h, row, _, _ = vec.words(cp, starts, commands=True)
                if not len(h):
                    continue
                d, t = items.matches(h, row)
                if len(d):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(d)), item_ids.take(pa.array(t))], names=schema_names)

    return run


def leaks(documents: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id: the document holds at least 13 consecutive words of the item."""
    spark = documents.sparkSession
    test = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = test.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (2 * block_words)))  # a word takes two characters at least
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    def hits(b: int) -> tuple[DataFrame, Broadcast]:
        block = test.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow()
        texts = block.column("text").combine_chunks() if block.num_rows else pa.array([], pa.string())
        shared = spark.sparkContext.broadcast(Items.of(block.column("item_id").to_pylist(), texts))
        return docs.mapInArrow(_scan(shared, ["doc_id", "item_id"]), "doc_id bigint, item_id bigint"), shared

    if blocks == 1:
        return hits(0)[0].distinct()
    parts = []
    for b in range(blocks):
        found, shared = hits(b)
        parts.append(checkpoint(found.distinct()))
        shared.destroy()
    return reduce(DataFrame.unionAll, parts)
