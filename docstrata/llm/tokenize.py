"""Encoding of a corpus with a public byte-level BPE (problem 8).

The lexicon is a minimal acyclic transducer. All words of the corpus are counted (partial sums in the
mappers), and the LEXICON_WORDS most frequent are merged once and compiled, in sorted order, into an
automaton with shared suffixes whose arcs carry the outputs' sums: a word's path adds up to its
rank, and the rank points at its sequence of ids. The arrays are written once to a file and
memory-mapped by every worker of an executor. All distinct words of a batch pass the automaton at once,
one byte a step. A word that is not in it is merged exactly by byte-pair ranks, so the size
of the lexicon changes the time and never the ids.

Text is cut into words for a whole batch at once: the public pattern's alternatives are
expressed on the classes of neighbouring characters. Equal words of a batch are found by
hash and compared character by character, looked up once, and their ids are spread back.

Results: one row per document; a null and an empty text both give the empty list; text is
encoded as stored, special tokens' strings as ordinary text. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import mmap
import os
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.llm import vec

TOKENIZER_DIR = os.environ.get("DOCSTRATA_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Characters of a batch that are worked on at once.
CHUNK = 2_000_000
#: Words compiled into the automaton, and the longest of them in bytes; all others are merged one by one.
LEXICON_WORDS, LEXICON_BYTES = 65_536, 64
#: Distinct words that a mapper counts, or remembers the ids of, before it starts anew.
HELD_WORDS = 100_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def build_transducer(entries: list[tuple[bytes, list[int]]]) -> dict[str, np.ndarray]:
    """Minimal acyclic automaton of sorted keys with their id sequences, built one key at a time with a register
    of finished states; the number of words passed on the way is the output of an arc."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, list[tuple[int, int]]]] = []

    def finish(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(states)
            states.append((final, arcs))
        return register[key]

    open_: list[list] = [[False, []]]  # the path of the last key: final, arcs
    last = b""
    for word, _ in entries:
        common = len(os.path.commonprefix([last, word]))
        while len(open_) > common + 1:
            done = open_.pop()
            open_[-1][1].append((last[len(open_) - 1], finish(*done)))
        for _ in word[common:]:
            open_.append([False, []])
        open_[-1][0] = True
        last = word
    while len(open_) > 1:
        done = open_.pop()
        open_[-1][1].append((last[len(open_) - 1], finish(*done)))
    start = finish(*open_[0])
    count = np.zeros(len(states), np.int64)
    arc, target, output = [], [], []
    for i, (final, arcs) in enumerate(states):  # targets are finished before their sources
        passed = int(final)
        for b, t in arcs:
            arc.append(256 * i + b)
            target.append(t)
            output.append(passed)
            passed += int(count[t])
        count[i] = passed
    ids = [i for _, sequence in entries for i in sequence]
    seq = np.concatenate([[0], np.cumsum([len(sequence) for _, sequence in entries])]) if entries else [0]
    values = {"start": [start], "final": [s[0] for s in states], "arc": arc, "target": target, "output": output, "seq": seq, "ids": ids}
    return {k: np.array(v, np.int32) for k, v in values.items()}


class Lexicon:
    """The memory-mapped transducer, and the entries of the vocabulary for the merging of other words."""

    NAMES = ("start", "final", "arc", "target", "output", "seq", "ids", "entry", "bytes")

    def __init__(self, path: str):
        with open(path, "rb") as f:
            m = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes, at = np.frombuffer(m, np.int64, len(self.NAMES)), 8 * len(self.NAMES)
        for name, n in zip(self.NAMES, sizes.tolist()):
            setattr(self, name, np.frombuffer(m, np.int32, n, at))
            at += 4 * n
        self.known: dict[str, list[int]] = {}

    @classmethod
    def write(cls, arrays: dict[str, np.ndarray], ranks: dict[bytes, int], path: str) -> None:
        """ranks: the vocabulary; ids that stand for no bytes are left out."""
        entries = sorted(ranks, key=ranks.__getitem__)
        ends = np.cumsum([len(e) for e in entries])
        blob = b"".join(entries)
        values = arrays | {"entry": np.stack([[ranks[e] for e in entries], ends], 1).reshape(-1) if entries else np.zeros(0), "bytes": np.frombuffer(blob.ljust(-(-len(blob) // 4) * 4, b"\0"), np.int32)}
        own = f"{path}.{os.getpid()}"
        with open(own, "wb") as f:
            f.write(np.array([len(values[n]) for n in cls.NAMES], np.int64).tobytes())
            for n in cls.NAMES:
                f.write(values[n].astype(np.int32).tobytes())
        os.replace(own, path)

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        entry, blob = self.entry.reshape(-1, 2), self.bytes.tobytes()
        ends = entry[:, 1].tolist()
        return {blob[a:b]: i for i, a, b in zip(entry[:, 0].tolist(), [0, *ends], ends)}

    def find(self, raw: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Ranks of the words that begin at first in an array of bytes, -1 for those not in the automaton."""
        rank = np.full(len(first), -1, np.int64)
        at = np.flatnonzero((size > 0) & (size <= LEXICON_BYTES)) if len(self.arc) else np.zeros(0, np.int64)
        state, passed, step = np.full(len(at), self.start[0], np.int64), np.zeros(len(at), np.int64), 0
        while len(at):
            key = 256 * state + raw[first[at] + step]
            k = np.minimum(np.searchsorted(self.arc, key), len(self.arc) - 1)
            ok = self.arc[k] == key
            at, k = at[ok], k[ok]
            state, passed, step = self.target[k].astype(np.int64), passed[ok] + self.output[k], step + 1
            end = size[at] == step
            done = end & (self.final[state] == 1)
            rank[at[done]] = passed[done]
            at, state, passed = at[~end], state[~end], passed[~end]
        return rank

    def merged(self, word: str) -> list[int]:
        """Ids of a word by merging; the last ones are remembered."""
        ids = self.known.get(word)
        if ids is None:
            raw = word.encode("utf-8", "surrogatepass")
            one = self.ranks.get(raw)
            ids = [one] if one is not None else merge(raw, self.ranks)
            if len(self.known) >= HELD_WORDS:
                self.known.clear()
            self.known[word] = ids
        return ids


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Exact byte-pair merging: always the adjacent pair of the lowest rank, leftmost first."""
    rank = lambda x: ranks.get(x, -1)
    import heapq

    n = len(word)
    left, right, end = list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(word[i : i + 2])) >= 0]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = right[i] if end[i] else n
        if not end[i] or j >= n or end[j] != stop:
            continue  # a part of it was merged meanwhile
        end[i], right[i], end[j] = stop, right[j], 0
        if right[i] < n:
            left[right[i]] = i
            if (r := rank(word[i : end[right[i]]])) >= 0:
                heapq.heappush(heap, (r, i, end[right[i]]))
        if (p := left[i]) >= 0 and (r := rank(word[p:stop])) >= 0:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(rank(word[i : end[i]]))
        i = right[i]
    return out


def split(cp: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Start of every word of the public pattern: contractions; a space and letters, numbers or
    other marks; white space, without its last character if a word follows. Every text starts
    one, and so does the separator after it."""
    kind = vec.tables()[0][cp]
    n = len(cp)
    bound = np.zeros(n + 1, bool)
    bound[starts] = True
    bound[starts[1:] - 1] = True
    prev = np.concatenate([[0], kind[:-1]])
    space = kind == vec.SPACE
    change = kind != prev
    # A plain space before a run of non-space joins that run; a run of white space gives it up.
    nxt = np.concatenate([kind[1:], [vec.SPACE]])
    nxt_bound = bound[1:]
    gives = space & (nxt != vec.SPACE) & ~nxt_bound
    start = change.copy()
    start |= gives  # the last white space before a word stands alone or leads it
    lead = np.concatenate([[False], (gives & (cp == 32))[:-1]])
    start[lead] = False  # the word starts at its space
    out = start | bound[:n]
    # Contractions: 's 't 'm 'd 're 've 'll wherever a word could start at the apostrophe.
    q = np.flatnonzero((cp == 39) & out)
    if len(q):
        pad = np.concatenate([cp, np.zeros(3, cp.dtype)])
        a, b = pad[q + 1], pad[q + 2]
        one = np.isin(a, [ord(c) for c in "sdmt"])
        two = ((a == 108) & (b == 108)) | ((a == 118) & (b == 101)) | ((a == 114) & (b == 101))
        size = np.where(one, 2, np.where(two, 3, 0))
        for at, k in zip(q[size > 0].tolist(), size[size > 0].tolist()):
            out[at + 1 : at + k] = False
            if at + k < n:
                out[at + k] = True
    return np.flatnonzero(out)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Code points; text of every word; start and size of the distinct words; which of them each word is."""
    cp, starts = vec.codepoints(texts)
    if not len(cp):
        return None
    s = split(cp, starts)
    e = np.concatenate([s[1:], [len(cp)]])
    row = np.searchsorted(starts, s, "right") - 1
    keep = s != starts[row + 1] - 1  # the separators
    s, e, row = s[keep], e[keep], row[keep]
    h = vec.span_hashes(cp, s, e)
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    size = e - s
    same = bool(np.all(size == size[first][inverse]))
    if same:
        base = np.repeat(s[first][inverse] - s, size)
        at = gathered(s, size)
        same = bool(np.array_equal(cp[at], cp[at + base]))
    if not same:  # two words of one hash: every word stands for itself
        first, inverse = np.arange(len(s)), np.arange(len(s))
    return cp, row, s[first], size[first], inverse


def gathered(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices first, first + 1, ... of size members, one stretch after the other."""
    total = int(size.sum())
    return np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(total) if total else np.zeros(0, np.int64)


def encode_batch(texts: pa.Array, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in order, and how many each has."""
    found = words_of(texts)
    if found is None:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    cp, row, s, size, inverse = found
    chars = cp[gathered(s, size)]
    raw = np.frombuffer(chars.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
    width = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
    ends = np.concatenate([[0], np.cumsum(width)])
    char = np.concatenate([[0], np.cumsum(size)])
    rank = lexicon.find(raw, ends[char[:-1]], ends[char[1:]] - ends[char[:-1]])
    text = cp.tobytes()
    lost = np.flatnonzero(rank < 0)
    lists = [lexicon.merged(text[4 * a : 4 * (a + n)].decode("utf-32-le", "surrogatepass")) for a, n in zip(s[lost].tolist(), size[lost].tolist())]
    own = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.concatenate([lexicon.ids, np.fromiter((x for ids in lists for x in ids), np.int32, int(own.sum()))])
    begin, many = np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
    held = rank >= 0
    begin[held] = lexicon.seq[rank[held]]
    many[held] = lexicon.seq[rank[held] + 1] - begin[held]
    begin[lost], many[lost] = len(lexicon.ids) + np.concatenate([[0], np.cumsum(own)[:-1]])[: len(own)], own
    n = many[inverse]
    return flat[gathered(begin[inverse], n)], np.bincount(row, n, len(texts)).astype(np.int64)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of about CHUNK characters."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.utf8_length(texts), 0), np.int64)) if len(texts) else np.zeros(0, np.int64)
    cuts = np.unique(np.concatenate([[0], np.searchsorted(sizes, np.arange(CHUNK, int(sizes[-1]) if len(sizes) else 0, CHUNK)), [len(texts)]])).tolist()
    return zip(cuts, cuts[1:])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> word, n: the words that an automaton may hold, with their numbers; partial sums."""
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        texts = batch.column(0)
        for a, b in _chunks(texts):
            found = words_of(texts.slice(a, b - a))
            if found is None:
                continue
            cp, _, s, size, inverse = found
            lone = np.concatenate([[0], np.cumsum((cp >= 0xD800) & (cp < 0xE000))])  # surrogates, which no column of words can hold
            ok = (size <= LEXICON_BYTES) & (lone[s + size] == lone[s])
            text, n = cp.tobytes(), np.bincount(inverse, minlength=len(s))
            for x, y, k in zip(s[ok].tolist(), size[ok].tolist(), n[ok].tolist()):
                held[text[4 * x : 4 * (x + y)].decode("utf-32-le")] += k
        if len(held) > HELD_WORDS:
            yield flush()
            held.clear()
    yield flush()


def _merged(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(SparkFiles.get(vocabulary))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([lexicon.merged(w) for w in batch.column(0).to_pylist()], pa.list_(pa.int32()))], names=["word", "ids"])

    return run


def ship(spark: SparkSession, entries: list[tuple[bytes, list[int]]], ranks: dict[bytes, int]) -> str:
    """Compile a lexicon on the driver and let Spark send the file to its executors. Returns its name
    among Spark's files; equal lexicons are sent once a session."""
    arrays = build_transducer(entries)
    digest = hashlib.sha256(b"".join(arrays[k].tobytes() for k in sorted(arrays)) + repr(len(ranks)).encode() + b"".join(ranks)).hexdigest()[:16]
    name = f"lexicon-{digest}.bin"
    sc = spark.sparkContext
    if not any(x.endswith(name) for x in sc.listFiles):
        path = os.path.join(SparkFiles.getRootDirectory(), f"built-{name}", name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        Lexicon.write(arrays, ranks, path)
        sc.addFile(path)
    return name


def frequent_words(documents: DataFrame, vocabulary: str, limit: int) -> list[tuple[bytes, list[int]]]:
    """The limit most frequent words of all texts (ties: by the word) with their ids, sorted by their bytes."""
    words = documents.select(F.col("text").cast("string")).mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    top = words.orderBy(F.desc("n"), "word").limit(limit).select("word").repartition(8).mapInArrow(_merged(vocabulary), "word string, ids array<int>").toArrow()
    return sorted((w.encode("utf-8"), ids) for w, ids in zip(top.column(0).to_pylist(), top.column(1).to_pylist()))


def encode(documents: DataFrame, vocabulary: str | None = None, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, ids."""
    spark = documents.sparkSession
    ranks = load_ranks(vocabulary or os.path.join(TOKENIZER_DIR, VOCABULARY))
    name = ship(spark, frequent_words(documents, ship(spark, [], ranks), lexicon_words), ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(SparkFiles.get(name))
        for batch in batches:
            texts = batch.column(1)
            for a, b in _chunks(texts):
                ids, n = encode_batch(texts.slice(a, b - a), lexicon)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["doc_id", "ids"])

    return documents.select("doc_id", F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, ids array<int>")
