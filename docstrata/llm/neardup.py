"""Near-duplicate texts and image fingerprints (problem 5).

Texts: SuperMinHash. Every distinct word sequence ranks the signature's positions by a
random permutation drawn step by step; the ranks are correlated, which lowers the variance,
and a text stops as soon as no later step can lower a position. Signatures are cut into
bands; equal bands give candidates; candidates are screened by one bit of each position and
verified on the whole sets of sequences. Equal texts are one class before banding, in the
mapper and again in the bucket, so a text copied a million times enters each bucket once.

Images: bit blocks. A 256-bit hash has 32 blocks of 8 bits; with at most 24 differing bits
8 blocks are equal at least. The blocks are dealt into groups, so that some of the equal ones share
a group (pigeonhole), and every set of so many inside a group is a table key: no pair within the
radius is missed. How many blocks make a key (2, 3 or 4) follows from the number of hashes.
Candidates are screened on 96 bits and verified on all 256.

Buckets travel as packed arrays of one part of the key space, not as rows. A bucket of more than
BUCKET_ROWS is cut into blocks and compared block by block in many tasks; nothing is left out.

Results: pairs are distinct, left < right by code point. Texts with fewer than 40 words, null
and empty ones have no pair. Hashes that aren't 64 hex digits are compared only with
themselves, so they have none. Different texts are linked one by one, also where their words are
equal. Of more than EXPAND copies, equal in every byte, the smallest id stands for all: in pairs
with other texts, and in a pair with each copy. p5_copies has the copies of all texts, from which
the other pairs follow, and n_links of p5_groups counts these too.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.llm import vec
from docstrata.llm.components import components
from docstrata.runtime import checkpoint, shuffle_partitions

WORDS = 3
MIN_WORDS = 40
SIMILARITY = 0.5
ROWS, BANDS = 4, 64
POSITIONS = ROWS * BANDS
LONGS = POSITIONS // 64
#: Of the POSITIONS bits two texts of similarity 0.5 agree in 75 %, unrelated ones in half.
SCREEN_BAND, SCREEN_ALL = 38, 168
EXPAND = 64
#: Parts of the key space for each shuffle partition; many parts make partitions even.
PARTS = 16
#: Bytes of packed rows that a task takes, and from how many tasks on it takes more.
TASK_BYTES, MANY_TASKS = 8_000_000, 20_000
#: Rows of a bucket that one task compares; a larger bucket is compared block by block.
BUCKET_ROWS = 16_384
CHUNK_SHINGLES = 60_000
BUCKET = np.dtype([("k", "<u4"), ("h", "<u8"), ("s", "<u8")])


def superminhash(shingles: np.ndarray, doc: np.ndarray, docs: int, m: int = POSITIONS) -> np.ndarray:
    """Signatures (docs x m, uint64) of the sets of distinct shingles; doc is sorted."""
    sig = np.full((docs, m), np.uint64(m) << np.uint64(32), np.uint64)
    flat = sig.reshape(-1)
    perm = np.broadcast_to(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(shingles), m)).copy()
    at = np.arange(len(shingles))
    for j in range(m):
        with np.errstate(over="ignore"):
            x = vec.mix(shingles[at] + np.uint64(j + 1) * vec.GOLD)
        k = j + (((x & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        to = perm[at, k]
        perm[at, k] = perm[at, j]
        np.minimum.at(flat, doc[at] * m + to, (np.uint64(j) << np.uint64(32)) | (x >> np.uint64(32)))
        last = (sig.max(axis=1) >> np.uint64(32)).astype(np.int64)
        at = at[last[doc[at]] > j]
        if not len(at):
            break
    return sig


def text_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the texts of MIN_WORDS words or more: their index, a hash of their words, and their
    distinct word sequences (hash, and the place of the text among these texts; sorted)."""
    cp, starts = vec.codepoints(texts)
    h, row, _, _ = vec.words(cp, starts)
    n = np.bincount(row, minlength=len(texts))
    big = np.flatnonzero(n >= MIN_WORDS)
    place = np.full(len(texts), -1)
    place[big] = np.arange(len(big))
    keep = place[row] >= 0
    h, row = h[keep], place[row[keep]]
    first = np.concatenate([[0], np.cumsum(n[big])])
    rank = np.arange(len(h)) - first[row] if len(h) else np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        key = np.add.reduceat(vec.mix(h + rank.astype(np.uint64) * vec.GOLD), first[:-1]) if len(big) else np.zeros(0, np.uint64)
    g, at = vec.ngrams(h, row, WORDS)
    doc = row[at]
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    return big, vec.mix(key), g[new], doc[new]


def _slices(docs: int, doc: np.ndarray, size: int) -> Iterator[tuple[int, int, int, int]]:
    """Cut texts into stretches of about size sequences: first text, end, first sequence, end."""
    first = np.searchsorted(doc, np.arange(docs + 1))
    a = 0
    while a < docs:
        b = max(a + 1, int(np.searchsorted(first, first[a] + size, "right")) - 1)
        yield a, b, int(first[a]), int(first[b])
        a = b


RECORDS = "id string, h bigint, t bigint, sig binary, grams binary"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text, t -> RECORDS of the texts of MIN_WORDS words or more. The signature (16 bits a position) and the
    distinct sequences (32 bits each) stand in the first row of each word sequence of the partition."""
    seen: set[int] = set()
    w = 2 * POSITIONS
    for batch in batches:
        big, key, g, doc = text_sets(batch.column(1))
        ids, t = batch.column(0).take(pa.array(big)), batch.column(2).take(pa.array(big))
        for a, b, x, y in _slices(len(key), doc, CHUNK_SHINGLES):
            keys = vec.signed(key[a:b]).tolist()
            fresh = [i for i, k in enumerate(keys) if k not in seen and not seen.add(k)]
            place = np.full(b - a, -1)
            place[fresh] = np.arange(len(fresh))
            d = place[doc[x:y] - a]
            gram, d = g[x:y][d >= 0], d[d >= 0]
            rows = vec.mix(superminhash(gram, d, len(fresh))).astype(np.uint16).tobytes() if fresh else b""
            first = np.searchsorted(d, np.arange(len(fresh) + 1))
            gram = (gram >> np.uint64(32)).astype("<u4")
            sig, grams = [None] * (b - a), [None] * (b - a)
            for n, i in enumerate(fresh):
                sig[i] = rows[n * w : n * w + w]
                grams[i] = np.unique(gram[first[n] : first[n + 1]]).tobytes()
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(keys, pa.int64()), t.slice(a, b - a), pa.array(sig, pa.binary()), pa.array(grams, pa.binary())], names=["id", "h", "t", "sig", "grams"])


def _bits(sig: np.ndarray) -> np.ndarray:
    """One bit of each position, packed."""
    return np.packbits((sig & 1).astype(np.uint8), axis=1)


def _packed(key: np.ndarray, rows: np.ndarray, parts: int) -> pa.RecordBatch | None:
    """Rows grouped into one binary per part of the key space."""
    part = (key % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, rows = part[order], rows[order]
    cut = np.flatnonzero(np.diff(part)) + 1
    first = np.concatenate([[0], cut])
    end = np.concatenate([cut, [len(part)]])
    return pa.RecordBatch.from_arrays([pa.array(part[first]), pa.array([rows[a:b].tobytes() for a, b in zip(first.tolist(), end.tolist())], pa.binary())], names=["part", "rows"])


def _band_parts(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            h = np.asarray(batch.column(0)).view(np.uint64)
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(h), POSITIONS)
            s = _bits(sig[:, ::LONGS]).copy().view(np.uint64)[:, 0]
            band = np.ascontiguousarray(sig).view(np.uint64)  # four positions of 16 bits
            with np.errstate(over="ignore"):
                key = vec.mix(band + np.arange(1, BANDS + 1, dtype=np.uint64) * vec.GOLD).reshape(-1)
            rows = np.empty(len(key), BUCKET)
            rows["k"], rows["h"], rows["s"] = (key >> np.uint64(32)).astype(np.uint32), np.repeat(h, BANDS), np.repeat(s, BANDS)
            yield _packed(key, rows, parts)

    return run


def _bucket_pairs(k: np.ndarray, block: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of equal sorted keys, in blocks of distance: j = i + 1, i + 2, ..."""
    n = len(k)
    i = np.arange(n)
    d = 1
    while len(i):
        i = i[i + d < n]
        i = i[k[i] == k[i + d]]
        for a in range(0, len(i), block):
            yield i[a : a + block], i[a : a + block] + d
        d += 1


def _blobs(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The packed rows of each part; a partition comes sorted by part, so one part is held at a time."""
    held: list[np.ndarray] = []
    part = None
    for batch in batches:
        for p, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if p != part and held:
                yield part, held
                held = []
            part = p
            held.append(np.frombuffer(r, kind))
    if held:
        yield part, held


STAGE = "a bigint, b bigint, k bigint, block int, blocks int, rows binary"


def _stage(pairs: pa.RecordBatch | None = None, hot: list[tuple[int, int, int, bytes]] = ()) -> pa.RecordBatch:
    n, m = pairs.num_rows if pairs is not None else 0, len(hot)
    wide = [pa.concat_arrays([c, pa.nulls(m, pa.int64())]) for c in pairs.columns] if n else [pa.nulls(m, pa.int64())] * 2
    cols = list(zip(*hot)) if m else [()] * 4
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([*wide, *[pa.concat_arrays([pa.nulls(n, t), pa.array(c, t)]) for c, t in zip(cols, kinds)]], names=["a", "b", "k", "block", "blocks", "rows"])


def _in_buckets(kind: np.dtype, similar, size: int):
    """part, rows -> STAGE: the candidate pairs of all buckets of up to size rows; larger buckets come out
    as blocks of size rows, to be compared pair by pair of blocks in tasks of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _blobs(batches, kind):
            rows = np.concatenate(held)
            rows = rows[np.lexsort((rows["h"], rows["k"]))]
            new = np.ones(len(rows), bool)
            new[1:] = (rows["k"][1:] != rows["k"][:-1]) | (rows["h"][1:] != rows["h"][:-1])
            rows = rows[new]
            first = np.flatnonzero(np.concatenate([[True], rows["k"][1:] != rows["k"][:-1]])) if len(rows) else np.zeros(0, np.int64)
            n = np.diff(np.concatenate([first, [len(rows)]]))
            for f, m in zip(first[n > size].tolist(), n[n > size].tolist()):
                blocks = -(-m // size)
                for i in range(blocks):
                    yield _stage(hot=[(int(rows["k"][f]), i, blocks, rows[f + i * size : f + min(m, (i + 1) * size)].tobytes())])
            rows = rows[np.repeat(n <= size, n)]
            held_pairs, count = [], 0
            for i, j in _bucket_pairs(rows["k"].copy()):
                ok = similar(rows, i, rows, j)
                if ok.any():
                    held_pairs.append(np.stack([rows["h"][i[ok]], rows["h"][j[ok]]], 1))
                    count += len(held_pairs[-1])
                if count > 500_000:
                    yield _stage(_pair_batch(np.concatenate(held_pairs)))
                    held_pairs, count = [], 0
            if held_pairs:
                yield _stage(_pair_batch(np.concatenate(held_pairs)))

    return run


def _between_blocks(kind: np.dtype, similar):
    """unit, rows -> a, b: all pairs between the two blocks of a unit (or inside its one block)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (x, *other) in _blobs(batches, kind):
            y = other[0] if other else x
            j = np.arange(len(y))
            held, count = [], 0
            for i in range(len(x)):
                ok = similar(x, np.full(len(y), i), y, j)
                if not other:
                    ok &= j > i
                if ok.any():
                    held.append(np.stack([np.full(int(ok.sum()), x["h"][i]), y["h"][ok]], 1))
                    count += len(held[-1])
                if count > 500_000:
                    yield _pair_batch(np.concatenate(held))
                    held, count = [], 0
            if held:
                yield _pair_batch(np.concatenate(held))

    return run


def bucket_candidates(blobs: DataFrame, tasks: int, kind: np.dtype, similar, size: int | None = None) -> DataFrame:
    """a, b: distinct candidate pairs of packed buckets. A bucket of more than size rows is cut into blocks, and
    every pair of its blocks is a unit of work that any task may take: no bucket is one task or one array."""
    size = size or BUCKET_ROWS
    stage = checkpoint(blobs.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(_in_buckets(kind, similar, size), STAGE))
    pairs = stage.where(F.col("a").isNotNull()).select("a", "b")
    hot = stage.where(F.col("k").isNotNull())
    if not hot.isEmpty():
        other = hot.select("k", "block", "rows", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to"))
        units = other.select(F.xxhash64("k", F.least("block", "to"), F.greatest("block", "to")).alias("unit"), "rows")
        pairs = pairs.unionAll(units.repartition(tasks, "unit").sortWithinPartitions("unit").mapInArrow(_between_blocks(kind, similar), "a bigint, b bigint"))
    return pairs.distinct()


def tasks_for(rows: int, width: int, spark) -> int:
    """Partitions for that many packed rows: TASK_BYTES each, more only where they would be over MANY_TASKS."""
    total = rows * width
    return max(shuffle_partitions(spark), -(-total // max(TASK_BYTES, total // MANY_TASKS)))


def _texts_alike(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x["s"][i] ^ y["s"][j]) <= 64 - SCREEN_BAND


def _pair_batch(pairs: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.sort(pairs.view(np.int64), axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], names=["a", "b"])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, POSITIONS)
            w = np.ascontiguousarray(_bits(sig)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.ascontiguousarray(w[:, i])) for i in range(w.shape[1])]], names=["h", *(f"s{i}" for i in range(LONGS))])


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                p, q = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                both = len(np.intersect1d(p, q, assume_unique=True))
                if both >= threshold * (len(p) + len(q) - both):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    return run


def text_records(elements: DataFrame) -> DataFrame:
    """RECORDS of all ids: class of equal words (h), in it that of equal bytes (t), signature and sequences."""
    long = elements.where((F.length("text") >= 2 * MIN_WORDS - 1) & F.col("id").isNotNull())
    return long.select("id", "text", F.xxhash64("text").alias("t")).mapInArrow(_records, RECORDS)


def text_links(elements: DataFrame, threshold: float = SIMILARITY, bucket_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(members: id, h, t) and (links: a, b between the classes of equal word sequences)."""
    spark = elements.sparkSession
    records = checkpoint(text_records(elements))
    members = records.select("id", "h", "t").distinct()
    classes = records.where(F.col("sig").isNotNull())
    tasks = tasks_for(classes.count() * BANDS, BUCKET.itemsize, spark)
    signatures = classes.select("h", "sig")
    blobs = signatures.mapInArrow(_band_parts(tasks * PARTS), "part int, rows binary")
    candidates = bucket_candidates(blobs, tasks, BUCKET, _texts_alike, bucket_rows)
    sketch = signatures.mapInArrow(_sketches, "h bigint" + "".join(f", s{i} bigint" for i in range(LONGS))).dropDuplicates(["h"])
    left = sketch.select(F.col("h").alias("a"), *[F.col(f"s{i}").alias(f"a{i}") for i in range(LONGS)])
    right = sketch.select(F.col("h").alias("b"), *[F.col(f"s{i}").alias(f"b{i}") for i in range(LONGS)])
    differ = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(LONGS)), F.lit(0))
    likely = checkpoint(candidates.join(left, "a").join(right, "b").where(differ <= POSITIONS - SCREEN_ALL).select("a", "b"))
    wanted = likely.select(F.col("a").alias("h")).unionAll(likely.select("b")).distinct()
    sets = classes.select("h", "grams").join(wanted, "h", "left_semi").groupBy("h").agg(F.first("grams").alias("grams"))
    pairs = likely.join(sets.select(F.col("h").alias("a"), F.col("grams").alias("x")), "a").join(sets.select(F.col("h").alias("b"), F.col("grams").alias("y")), "b")
    links = pairs.select("a", "b", "x", "y").mapInArrow(_verify(threshold), "a bigint, b bigint")
    return members, links


def _groups_of(blocks: int, groups: int, r: int = 2) -> list[tuple[int, ...]]:
    """Sets of r blocks inside the groups that the blocks are dealt into."""
    return [c for g in range(groups) for c in combinations(range(g, blocks, groups), r)]


BLOCKS = 32
RADIUS = 24
HASH_BUCKET = np.dtype([("k", "<u4"), ("h", "<u8"), ("s", "<u8"), ("t", "<u4")])


def blocks_per_key(n: int, radius: int = RADIUS) -> int:
    """How many blocks of 8 bits make a key for n hashes. With r blocks a key, the equal ones fall into (equal - 1) //
    (r - 1) groups, so that r of them share one, which takes more tables but meets 1 in 2^8r unrelated pairs.
    The cheapest of keys written and pairs met; the keys grow slower than any power above 1.5 of n."""
    equal = BLOCKS - radius
    def cost(r: int) -> float:
        tables = len(_groups_of(BLOCKS, (equal - 1) // (r - 1), r))
        return n * tables + n * n / 2 * tables / 2.0 ** (8 * r)

    return min((r for r in (2, 3, 4) if r <= equal), key=cost, default=1)


def _hash_rows(parts: int, radius: int, r: int):
    equal = BLOCKS - radius
    tables = np.array(_groups_of(BLOCKS, (equal - 1) // (r - 1) if r > 1 else 1, r))
    n = len(tables)
    step = max(1, 1_000_000 // n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                raw = np.frombuffer(bytes.fromhex("".join(whole.column(0).slice(at, step).to_pylist())), np.uint8).reshape(-1, 32)
                w = np.ascontiguousarray(raw).view(np.uint64)
                with np.errstate(over="ignore"):
                    h = vec.mix(w[:, 0] + vec.mix(w[:, 1] + vec.mix(w[:, 2] + vec.mix(w[:, 3]))))
                    bits = np.zeros((len(raw), n), np.uint64)
                    for c in range(r):
                        bits = (bits << np.uint64(8)) | raw[:, tables[:, c]]
                    full = vec.mix((bits + np.uint64(1)) * np.uint64(n) + np.arange(n, dtype=np.uint64)).reshape(-1)
                rows = np.empty(len(full), HASH_BUCKET)
                rows["k"], rows["h"], rows["s"], rows["t"] = (full >> np.uint64(32)).astype(np.uint32), np.repeat(h, n), np.repeat(w[:, 0], n), np.repeat(w[:, 1].astype(np.uint32), n)
                yield _packed(full, rows, parts)

    return run


def _hashes_alike(radius: int):
    def similar(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> np.ndarray:
        return (np.bitwise_count(x["s"][i] ^ y["s"][j]) + np.bitwise_count(x["t"][i] ^ y["t"][j])) <= radius

    return similar


def _hash_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            w = np.frombuffer(bytes.fromhex("".join(batch.column(0).to_pylist())), np.uint64).reshape(-1, 4)
            with np.errstate(over="ignore"):
                h = vec.mix(w[:, 0] + vec.mix(w[:, 1] + vec.mix(w[:, 2] + vec.mix(w[:, 3]))))
            yield pa.RecordBatch.from_arrays([pa.array(vec.signed(h)), batch.column(0), *[pa.array(vec.signed(np.ascontiguousarray(w[:, i]))) for i in range(4)]], names=["h", "hash", "w0", "w1", "w2", "w3"])


def hash_links(images: DataFrame, radius: int = RADIUS, width: int | None = None, bucket_rows: int | None = None) -> DataFrame:
    """left_key, right_key: different lower-cased image hashes within the radius. width: blocks a key."""
    spark = images.sparkSession
    hashes = checkpoint(images.select(F.lower("image_hash").alias("hash")).where(F.col("hash").rlike("^[0-9a-f]{64}$")).distinct())
    n = hashes.count()
    r = width or blocks_per_key(n, radius)
    tables = len(_groups_of(BLOCKS, (BLOCKS - radius - 1) // (r - 1) if r > 1 else 1, r))
    tasks = tasks_for(n * tables, HASH_BUCKET.itemsize, spark)
    blobs = hashes.mapInArrow(_hash_rows(tasks * PARTS, radius, r), "part int, rows binary")
    candidates = bucket_candidates(blobs, tasks, HASH_BUCKET, _hashes_alike(radius), bucket_rows)
    full = hashes.mapInArrow(_hash_keys, "h bigint, hash string, w0 bigint, w1 bigint, w2 bigint, w3 bigint")
    a = full.select(F.col("h").alias("a"), F.col("hash").alias("x"), *[F.col(f"w{i}").alias(f"a{i}") for i in range(4)])
    b = full.select(F.col("h").alias("b"), F.col("hash").alias("y"), *[F.col(f"w{i}").alias(f"b{i}") for i in range(4)])
    differ = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(4)), F.lit(0))
    return candidates.join(a, "a").join(b, "b").where((differ <= radius) & (F.col("x") != F.col("y"))).select(F.least("x", "y").alias("left_key"), F.greatest("x", "y").alias("right_key")).distinct()


def element_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """left_key, right_key: the pairs of element ids behind the classes and their links."""
    n = members.groupBy("h", "t").agg(F.count("*").alias("n"), F.min("id").alias("rep"))
    placed = members.join(n, ["h", "t"])
    star = placed.where((F.col("n") > EXPAND) & (F.col("id") != F.col("rep"))).select(F.col("rep").alias("left_key"), F.col("id").alias("right_key"))
    # More than EXPAND copies stand in pairs with other texts as their smallest id.
    shown = placed.where((F.col("n") <= EXPAND) | (F.col("id") == F.col("rep"))).select("h", "id")
    own = shown.join(members.groupBy("h").count().where("count > 1"), "h", "left_semi")
    inside = own.alias("x").join(own.alias("y"), "h").where(F.col("x.id") < F.col("y.id")).select(F.col("x.id").alias("left_key"), F.col("y.id").alias("right_key"))
    across = links.join(shown.select(F.col("h").alias("a"), F.col("id").alias("x")), "a").join(shown.select(F.col("h").alias("b"), F.col("id").alias("y")), "b").select(F.least("x", "y").alias("left_key"), F.greatest("x", "y").alias("right_key"))
    return inside.unionAll(star).unionAll(across).where(F.col("left_key") != F.col("right_key"))


def class_links(members: DataFrame, links: DataFrame) -> DataFrame:
    """h, near: every class with itself and the classes it is linked with, both ways."""
    return links.select("a", "b").unionAll(links.select("b", "a")).unionAll(members.select("h", "h")).distinct().toDF("h", "near")


def element_counts(members: DataFrame, links: DataFrame) -> DataFrame:
    """record_key, n_links: of how many pairs an id is, all copies counted. Sizes of classes are added along links of
    classes; only ids that came with several texts, and so stand in several classes, are followed one by one."""
    beside = class_links(members, links)
    held = members.select("id", "h").distinct()
    several = held.join(held.groupBy("id").count().where("count > 1"), "id", "left_semi")
    size = held.groupBy(F.col("h").alias("near")).agg(F.count("*").alias("n"))
    per_class = beside.join(size, "near").groupBy("h").agg(F.sum("n").alias("n"))
    # An id in several of the classes around a class is a member of each, but one partner.
    again = beside.join(several.select(F.col("id").alias("other"), F.col("h").alias("near")), "near").groupBy("h", "other").agg((F.count("*") - 1).alias("n")).groupBy("h").agg(F.sum("n").alias("again"))
    counted = per_class.join(again, "h", "left").select("h", (F.col("n") - F.coalesce("again", F.lit(0)) - 1).alias("n_links"))
    one = held.join(several, "id", "left_anti").join(counted, "h").select(F.col("id").alias("record_key"), "n_links")
    more = several.join(beside, "h").select("id", "near").distinct().join(held.select(F.col("id").alias("other"), F.col("h").alias("near")), "near")
    more = more.select("id", "other").distinct().groupBy(F.col("id").alias("record_key")).agg((F.count("*") - 1).alias("n_links"))
    return one.unionByName(more).where("n_links > 0")


def all_pairs(members: DataFrame, links: DataFrame, images: DataFrame) -> DataFrame:
    pairs = element_pairs(members, links).select(F.lit("element").alias("record_kind"), "left_key", "right_key")
    return pairs.unionAll(hash_links(images).select(F.lit("image").alias("record_kind"), "left_key", "right_key")).distinct()


def found(elements: DataFrame, images: DataFrame) -> DataFrame:
    """record_kind, left_key, right_key."""
    members, links = text_links(elements)
    return all_pairs(checkpoint(members), links, images)


def copies(elements: DataFrame) -> DataFrame:
    """element_id, copy_key, n_copies: the ids of texts with MIN_WORDS words or more, the smallest id
    with the same text, equal in every byte, and how many ids have it."""
    members = checkpoint(text_records(elements).select("id", "h", "t").distinct())
    n = members.groupBy("h", "t").agg(F.min("id").alias("copy_key"), F.count("*").alias("n_copies"))
    return members.join(n, ["h", "t"]).select(F.col("id").alias("element_id"), "copy_key", "n_copies").distinct()


def groups(elements: DataFrame, images: DataFrame) -> DataFrame:
    """record_kind, record_key, class_key, n_links: every element id and every non-empty lower-cased
    image hash with the smallest key of its group (its own if it is alone) and its links. Elements are
    grouped by the links of their classes; no pair of ids is written."""
    members, links = text_links(elements)
    members, links = checkpoint(members), checkpoint(links)
    between = checkpoint(hash_links(images))
    # An id with several texts ties their classes together.
    held = members.select("id", F.col("h").cast("string").alias("h")).distinct()
    ties = held.join(held.groupBy("id").agg(F.min("h").alias("low"), F.count("*").alias("n")).where("n > 1"), "id").select("low", "h")
    text = links.select(F.col("a").cast("string"), F.col("b").cast("string")).unionAll(ties)
    tagged = text.select(*[F.concat(F.lit("e"), c) for c in text.columns]).unionAll(between.select(F.concat(F.lit("i"), "left_key"), F.concat(F.lit("i"), "right_key"))).toDF("a", "b")
    member = components(tagged)
    nodes = held.select(F.lit("element").alias("record_kind"), F.col("id").alias("record_key"), F.concat(F.lit("e"), "h").alias("node"))
    hashes = images.where(F.length("image_hash") > 0).select(F.lit("image").alias("record_kind"), F.lower("image_hash").alias("record_key")).distinct()
    placed = nodes.unionByName(hashes.withColumn("node", F.concat(F.lit("i"), "record_key"))).join(member, "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = placed.groupBy("root").agg(F.min("record_key").alias("class_key"))
    found_ = placed.join(low, "root").groupBy("record_kind", "record_key").agg(F.min("class_key").alias("class_key"))
    n = between.select(F.explode(F.array("left_key", "right_key")).alias("record_key")).groupBy("record_key").agg(F.count("*").alias("n_links")).withColumn("record_kind", F.lit("image"))
    n = n.unionByName(element_counts(members, links).withColumn("record_kind", F.lit("element")))
    every = elements.where(F.col("id").isNotNull()).select(F.lit("element").alias("record_kind"), F.col("id").alias("record_key")).distinct().unionAll(hashes)
    joined = every.join(n, ["record_kind", "record_key"], "left").join(found_, ["record_kind", "record_key"], "left")
    return joined.select("record_kind", "record_key", F.coalesce("class_key", "record_key").alias("class_key"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
