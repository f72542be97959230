"""Noise in text from scanned pages (problem 3): a noisy channel over a corpus language model.

The language model holds counts of words and word pairs of the born-digital texts of the corpus
(all of them, by partial aggregation), from LEAST occurrences on, whatever the size of the corpus, so the
same text is read the same beside any other. The counts are sorted arrays of hashes in one file, which
the driver writes block by block and every worker maps into memory. Probabilities of character confusions
are counted over all distinct unknown words of the texts: those that one confusion turns into exactly one
known word. Confusions of the fixed list are known from the shapes of letters; others come from
aligning unknown words with known ones that differ in one place. A
line with unknown words is decoded by Viterbi over the candidates of each word: channel times
bigram likelihood. What looks like a tag or a number is decoded too if confusions turn it into a
known word; it stays if a tag is likelier. A word is misread if the best path reads it as another.

Before that, lines are put together: page numbers and running headers on lines of their own are
taken out, and a word at a line's end with a hyphen is joined with the next line's first when
the model knows the whole word, and kept as a compound when it knows the compound.

Results: rows of null or blank text give none; elements that are neither paragraphs nor list
items are no cases; every text of these is judged, whatever its source; of rows with one id all distinct texts are read and their noise is united;
null ids are left out. A text of a single line has no page furniture.
"""

from __future__ import annotations

import mmap
import os
import re
import shutil
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.runtime import checkpoint

#: Occurrences from which a word or pair is known, at every size of the corpus.
LEAST = 3
#: Different words in which a confusion must be seen that isn't in the list, and how much commoner these must be.
SUPPORT, COMMONER = 5, 10
#: Counts that a mapper holds, and rows of counts that the driver passes on, at once.
HELD, BLOCK = 200_000, 500_000
PROSE_TYPES = ("paragraph", "list_item")
#: What recognition shows, and what stood there.
CONFUSIONS = (
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "b"), ("8", "b"), ("9", "g"), ("@", "a"), ("4", "a"), ("3", "e"), ("2", "z"), ("7", "t"), ("$", "s"), ("!", "l"), ("!", "i"), ("|", "l"), ("|", "i"), ("q", "g"), ("€", "e"), ("(", "c"), ("\\/", "v"), ("|)", "d"), ("()", "o"), ("|<", "k"), ("/\\", "a"), ("\\/\\/", "w"),
    ("c", "e"), ("e", "c"), ("o", "c"), ("c", "o"), ("f", "t"), ("t", "f"), ("l", "i"), ("i", "l"), ("l", "t"), ("h", "b"), ("b", "h"), ("n", "u"), ("u", "n"), ("a", "o"), ("o", "a"), ("e", "o"), ("o", "e"), ("v", "y"), ("y", "v"), ("g", "q"), ("n", "h"), ("r", "t"), ("s", "5"), ("i", "j"), ("j", "i"), ("u", "v"), ("v", "u"), ("a", "e"), ("e", "a"),
    ("rn", "m"), ("m", "rn"), ("m", "in"), ("in", "m"), ("m", "ni"), ("m", "nn"), ("nn", "m"), ("vv", "w"), ("w", "vv"), ("ii", "u"), ("u", "ii"), ("ll", "u"), ("u", "ll"), ("li", "h"), ("h", "li"), ("cl", "d"), ("d", "cl"), ("H", "ti"), ("H", "fi"), ("h", "ti"), ("ri", "n"), ("n", "ri"), ("tl", "d"), ("fi", "h"), ("lc", "k"), ("k", "lc"), ("ti", "n"), ("f", "ti"), ("u", "ti"), ("ß", "b"), ("b", "ß"), ("rr", "n"), ("ni", "m"), ("iv", "w"), ("w", "iv"), ("lt", "k"), ("fl", "ﬂ"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("a", "ä"), ("o", "ö"), ("u", "ü"), ("ii", "ü"), ("ss", "ß"), ("B", "ß"),
)

TOKEN = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")
#: A word as it stands in a scanned text: anything between white space, without marks around it.
SEEN = re.compile(r"\S+")
EDGE = " \t.,;:?()[]{}\"“”„'’»«…*"
SKIP = re.compile(r"^(?:[A-Z]{1,5}[-/]?\d[\w.=/-]*|[\d.,:/%°+-]+\w{0,3}|.*[=<>].*|.*(?<!\\)/(?!\\).*|.*\\(?!/).*|[A-Z]{2,}|°?[A-Z]|\[\d+\])$")
#: Tags of instruments and bare numbers, as labels in pictures have them.
TAGS = re.compile(r"^(?:[A-Z]{1,5}[-/]?\d[\w./-]*|[\d.,]+)$")
#: What SKIP takes for a tag or a number, but may be a word with one or two letters read as digits.
MISTAKEN = re.compile(r"^(?=.{3})(?=(?:.*[^\W\d_]){2})(?!\d+(?:st|nd|rd|th|er|ers|ème)$)(?:[^\W\d_]*\d){1,2}[^\W\d_]*$")
#: A tag is as likely as so many words and its characters by chance.
TAG_SHARE, TAG_CHARACTERS = 1e-3, 36
UNKNOWN = 1e-11
LINE = re.compile(r"\r\n|[\n\r\u2028]")
HYPHEN = "\u2010\u2011\u00ac\u00ad-"
BREAK = re.compile(r"(\S+?)([\u2010\u2011\u00ac\u00ad-])[ \t\u00a0]*$")
PAGE = re.compile(
    r"^[\s\-–—|·*\[\](~.]*(?:(?:page|seite|página|pagina|blatt|sheet|folio|pg?\.?|s\.)\s*[-–—#:]?\s*)?(?:[\dOol]{1,5}|[ivxlcdmIVXLCDM]{1,7})(?:\s*(?:of|von|de|sur|/|aus)\s*\d{1,5})?[\s\-–—|·*\[\])~.]*$",
    re.IGNORECASE,
)
NUMBERED_END = re.compile(r"[\s\-–—|]+(?:page\s*)?(?:\d{1,4}(?:\s*/\s*\d{1,4})?|[ivxlc]{1,6})\s*$", re.IGNORECASE)


class Counts:
    """Numbers of words, pairs of words or lines by their hashes, in sorted arrays; the last ones asked are remembered."""

    def __init__(self, hashes: np.ndarray, numbers: np.ndarray):
        self.hashes, self.numbers = hashes, numbers
        self.seen: dict = {}

    def get(self, key: str | tuple[str, str], other: int = 0) -> int:
        n = self.seen.get(key)
        if n is None:
            if len(self.seen) > HELD:
                self.seen.clear()
            h = xxhash.xxh64_intdigest(key.encode("utf-8", "replace"), 42) if isinstance(key, str) else xxhash.xxh64_intdigest(key[1].encode("utf-8", "replace"), xxhash.xxh64_intdigest(key[0].encode("utf-8", "replace"), 42))
            k = int(np.searchsorted(self.hashes, np.uint64(h)))
            n = self.seen[key] = int(self.numbers[k]) if k < len(self.hashes) and self.hashes[k] == h else 0
        return n or other

    def __contains__(self, key) -> bool:
        return self.get(key) > 0

    def __getitem__(self, key) -> int:
        return self.get(key)

    def any_of(self, words: list[str]) -> list[int]:
        """Positions of the known ones among many words."""
        if not words or not len(self.hashes):
            return []
        h = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "replace"), 42) for w in words), np.uint64, len(words))
        return np.flatnonzero(self.hashes[np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)] == h).tolist()


class Plain(dict):
    """The same over a small dictionary."""

    def any_of(self, words: list[str]) -> list[int]:
        return [i for i, w in enumerate(words) if w in self]


class Model:
    """Counts of the corpus language and the confusion probabilities."""

    def __init__(self, words, pairs, headers, costs: dict[tuple[str, str], float] | None = None, total: int | None = None, longest: int | None = None):
        self.words, self.pairs, self.headers = Plain(words) if isinstance(words, dict) else words, pairs, headers
        self.total = max(1, sum(words.values()) if total is None else total)
        self.costs = costs or {c: log(1e-3) for c in CONFUSIONS}
        self.known: dict[str, list[tuple[str, float]]] = {}
        self.fine: set[str] = set()
        #: No true word is longer, and two confusions shorten what is seen by no more than this.
        self.longest = (max(map(len, words), default=0) if longest is None else longest) + 2 * max((len(s) - len(t) for s, t in self.costs), default=0)

    def plain(self, token: str) -> bool:
        """Whether a token, as it stands between white space, is read as it is in any context."""
        if token in self.fine:
            return True
        t = token.strip(EDGE)
        if t.lower() in self.words or not self.readable(t) or not self.candidates(t):
            if len(self.fine) > HELD:
                self.fine.clear()
            self.fine.add(token)
            return True
        return False

    def candidates(self, token: str) -> list[tuple[str, float]]:
        """All known words that one confusion, or two, may have turned into the token; best first."""
        if len(token) > self.longest:
            return []
        found = self.known.get(token)
        if found is None:
            cost: dict[str, float] = {}
            once = list(self._variants(token))
            for v, c in once:
                cost[v.lower()] = max(cost.get(v.lower(), -1e9), c)
            if len(token) >= 4:
                for v, c in once:
                    for w, c2 in self._variants(v):
                        cost[w.lower()] = max(cost.get(w.lower(), -1e9), c + c2)
            cost.pop(token.lower(), None)
            forms = list(cost)
            best = {forms[i]: cost[forms[i]] for i in self.words.any_of(forms)}
            found = sorted(best.items(), key=lambda x: (-x[1] - log(self.words[x[0]]), x[0]))
            if len(self.known) > HELD:
                self.known.clear()
            self.known[token] = found
        return found

    def _variants(self, token: str) -> Iterator[tuple[str, float]]:
        for (seen, true), cost in self.costs.items():
            at = token.find(seen)
            while at >= 0:
                yield token[:at] + true + token[at + len(seen) :], cost
                at = token.find(seen, at + 1)

    def readable(self, token: str) -> bool:
        """Whether a token is a word, or a tag or number that confusions turn into one."""
        return is_word(token) or bool(MISTAKEN.match(token) and self.candidates(token))

    def step(self, before: str, w: str) -> float:
        n = self.words.get(w, 0)
        if not n:
            return log(UNKNOWN)
        p = n / self.total
        m = self.words.get(before, 0)
        return log(0.3 * p + 0.7 * (self.pairs.get((before, w), 0) / m if m else p))

    def decode(self, tokens: list[str]) -> list[str]:
        """The most likely reading of a line's words (lower case)."""
        steps: list[list[tuple[float, str, int]]] = []
        last = [(0.0, "", -1)]
        for t in tokens:
            low = t.lower()
            options = [(low, log(0.97))]
            if low not in self.words and self.readable(t):
                options += self.candidates(t)
                if not is_word(t):
                    options[0] = (low, log(TAG_SHARE) - len(t) * log(TAG_CHARACTERS) - log(UNKNOWN))
            nxt = []
            for w, c in options:
                score, back = max((s + self.step(p, w), -k) for k, (s, p, _) in enumerate(last))
                nxt.append((score + c, w, -back))
            steps.append(nxt)
            last = nxt
        k = max(range(len(last)), key=lambda i: last[i][0])
        out = []
        for options in reversed(steps):
            out.append(options[k][1])
            k = options[k][2]
        return out[::-1]


def is_word(token: str) -> bool:
    return len(token) >= 2 and any(c.isalpha() for c in token) and not SKIP.match(token)


def header_key(line: str) -> str:
    """A running line without its page number, digits and case."""
    return re.sub(r"\d+", "#", re.sub(r"\s+", " ", NUMBERED_END.sub("", line.strip(" \t-–—|*"))).lower()).strip()


RUN = re.compile(r"[^\W_]+")
SMALL = re.compile(r"[ivxlc]+|of|von|and|und|the|for|der|die|für|de|la|page")


def titled(line: str) -> bool:
    """Every word of two letters or more begins with a capital or a digit, and there is no full stop."""
    if ":" in line or "•" in line or line.rstrip().endswith((".", ",", ";")):
        return False
    words = [w for w in RUN.findall(line) if len(w) > 1 and w[0].isalpha()]
    big = sum(w[0].isupper() for w in words)
    return big >= 2 and all(w[0].isupper() or SMALL.fullmatch(w) for w in words)


def furniture(lines: list[str], model: Model) -> list[bool]:
    """Which lines hold a page number or a running header."""
    flag = [False] * len(lines)
    if sum(bool(x.strip()) for x in lines) < 2:
        return flag
    for i, line in enumerate(lines):
        s = line.strip()
        if not s:
            continue
        if PAGE.match(s) and (any(c.isdigit() for c in s) or not s.endswith(".") and not re.fullmatch(r"[lcdmLCDMV]+", s)):
            flag[i] = True
        elif len(s) <= 90 and not s.endswith(".") and header_key(s) in model.headers:
            flag[i] = True
        elif len(s) <= 90 and titled(s) and not all(TAGS.match(w.strip(EDGE)) for w in s.split()):
            flag[i] = True
        elif i and not lines[i - 1].strip() and len(s) <= 60 and i + 1 < len(lines) and not lines[i + 1].strip() and NUMBERED_END.search(s) and titled(NUMBERED_END.sub("", s)):
            flag[i] = True
    if all(f or not x.strip() for f, x in zip(flag, lines)):
        return [False] * len(lines)
    return flag


def broken(left: str, right: str, model: Model) -> bool:
    """Does a word go on over the line end (True), or is it a compound with its own hyphen?"""
    a, b = left.lower(), right.lower()
    whole, compound = a + b, f"{a}-{b}"
    n, m = model.words.get(whole, 0), model.words.get(compound, 0)
    if n or m:
        return n >= m
    x, y = model.candidates(left + right), model.candidates(f"{left}-{right}")
    if x or y:
        return not y or bool(x) and x[0][1] > y[0][1]
    return not (a in model.words and b in model.words)


def repair(text: str, model: Model) -> tuple[str, set[str]]:
    """The readable text and the kinds of noise that were in it."""
    noise: set[str] = set()
    lines = LINE.split(text)
    flag = furniture(lines, model)
    if any(flag):
        noise.add("page_furniture")
    body = [x for x, f in zip(lines, flag) if not f and x.strip()]
    out: list[list[str]] = []
    carried: str | None = None
    for i, line in enumerate(body):
        tokens = line.split()
        if carried is not None and tokens:
            tokens[0] = carried + tokens[0]
            carried = None
        m = BREAK.search(line) if i + 1 < len(body) else None
        if m and tokens:
            nxt = body[i + 1].split()[0]
            right = nxt.strip(EDGE)
            left = tokens[-1].rstrip(HYPHEN + " ").lstrip(EDGE)
            if right and right[0].isalpha() and not right[0].isupper() and any(c.isalpha() for c in left) and (not SKIP.match(left) or model.readable(left + right)):
                stem = left.rsplit("-", 1)[-1] if "-" in left else left
                if broken(left, right, model) or (stem != left and broken(stem, right, model)):
                    noise.add("broken_word")
                    carried = tokens.pop().rstrip(HYPHEN)
                else:
                    carried = tokens.pop().rstrip(HYPHEN) + "-"
            elif right and left and (SKIP.match(left) or right[0].isdigit()):
                carried = tokens.pop().rstrip(HYPHEN) + "-"
        out.append(tokens)
    for k, tokens in enumerate(out):
        if not model.fine.issuperset(tokens) and not all(map(model.plain, tokens)):
            line = [t.strip(EDGE) for t in tokens]
            for j, (t, r) in enumerate(zip(line, model.decode(line))):
                if t.lower() != r:
                    noise.add("misread")
                    shown = r.capitalize() if t[:1].isupper() and t[:1].lower() == r[:1] else r
                    out[k][j] = out[k][j].replace(t, shown, 1)
    return " ".join(t for tokens in out for t in tokens), noise


# ---- the model over the corpus


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, clean, scan, head (what it is counted for) -> kind, a, b, n: partial sums. The words of texts that may be
    scanned are counted line by line, without those that a line's end cuts."""
    counts: Counter = Counter()
    raw: Counter = Counter()  # what stands between white space; asked once whether it is a word

    def flush() -> pa.RecordBatch:
        for w, n in raw.items():
            if is_word(t := w.strip(EDGE)):
                counts["scan", t, ""] += n
        kind, a, b = zip(*counts) if counts else ((), (), ())
        batch = pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(counts.values(), pa.int64())], names=["kind", "a", "b", "n"])
        counts.clear()
        raw.clear()
        return batch

    for batch in batches:
        for text, clean, scan, head in zip(*(c.to_pylist() for c in batch.columns)):
            if scan:
                for line in LINE.split(text):
                    seen = line.split()
                    if seen and seen[-1].rstrip(EDGE).endswith(tuple(HYPHEN)):
                        seen.pop()
                    raw.update(seen)
            if head:
                counts["head", header_key(text), ""] += 1
            if clean:
                low = TOKEN.findall(text.lower())
                counts.update(zip(repeat("word"), low, repeat("")))
                counts.update(zip(repeat("pair"), low, low[1:]))
            if len(counts) + len(raw) > HELD:
                yield flush()
    yield flush()


def _one_confusion(name: str, confusions: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = read_model(name)[0]
        seen: Counter = Counter()
        for batch in batches:
            for token, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if token.lower() in words:
                    seen[("", "")] += n
                    continue
                forms = [(token[:at] + t + token[at + len(s) :], (s, t)) for s, t in confusions for at in places(token, s)]
                hits = {forms[i][1] for i in words.any_of([f.lower() for f, _ in forms])}
                if len(hits) == 1:
                    seen[hits.pop()] += n
        if seen:
            s, t = zip(*seen)
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(t), pa.array(seen.values(), pa.int64())], names=["s", "t", "n"])

    return run


def places(text: str, part: str) -> Iterator[int]:
    at = text.find(part)
    while at >= 0:
        yield at
        at = text.find(part, at + 1)


def learned_confusions(counts: DataFrame) -> list[tuple[str, str]]:
    """What stands in unknown words where a known word, at least COMMONER times as frequent, has something else: up to four
    characters for one or two, in one place, the word on both sides of it being equal. Kept with SUPPORT different words."""
    words = counts.where("kind = 'word'").select(F.col("a").alias("w"), "n")
    tokens = counts.where("kind = 'scan'").groupBy(F.lower("a").alias("w")).agg(F.sum("n").alias("n")).join(words.select("w"), "w", "left_anti")

    def holes(df: DataFrame, most: int, name: str) -> DataFrame:
        cut = df.where(F.length("w").between(4, 40)).select("w", "n", F.explode(F.sequence(F.lit(1), F.lit(most))).alias("k")).where(F.col("k") < F.length("w") - 1)
        at = cut.select("w", "n", "k", F.explode(F.sequence(F.lit(1), F.length("w") - F.col("k") + 1)).alias("i"))
        left, right = F.expr("substring(w, 1, i - 1)"), F.expr("substring(w, i + k)")
        return at.select(F.xxhash64(left, right).alias("hole"), F.expr("substring(w, i, k)").alias(name), F.col("w").alias(f"{name}_word"), F.col("n").alias(f"{name}_n"))

    pairs = holes(tokens, 4, "s").join(holes(words, 2, "t"), "hole").where((F.col("t_n") >= COMMONER * F.col("s_n")) & (F.left("s", F.lit(1)) != F.left("t", F.lit(1))) & (F.right("s", F.lit(1)) != F.right("t", F.lit(1))))
    one = pairs.groupBy("s_word").agg(F.count_distinct("t_word").alias("words"), F.min(F.struct(F.length("s") + F.length("t"), "s", "t", "t_word")).alias("best")).where("words = 1")
    rows = one.groupBy("best.s", "best.t").agg(F.count_distinct("best.t_word").alias("support")).where(F.col("support") >= SUPPORT).collect()
    return sorted((r[0], r[1]) for r in rows)


def records(elements: DataFrame, images: DataFrame) -> DataFrame:
    """record_kind, record_id, text of all paragraphs, list items and texts of images."""
    e = elements.where(F.col("type").isin(*PROSE_TYPES) & F.col("id").isNotNull() & (F.length(F.trim("text")) > 0)).select(F.lit("element").alias("record_kind"), F.col("id").alias("record_id"), "text")
    i = images.where(F.col("id").isNotNull() & (F.length(F.trim("ocr_text")) > 0)).select(F.lit("image").alias("record_kind"), F.col("id").alias("record_id"), F.col("ocr_text").alias("text"))
    return e.unionAll(i)


ARRAYS = ("words", "word_n", "pairs", "pair_n", "heads", "head_n")


def write_model(counts: DataFrame, kind: str) -> tuple[str, int, int]:
    """The counts as sorted arrays in one file, sent to the executors: its name, the sum and the longest word. kind: of which
    words the language is ('word', or 'scan' where nothing is born digital). Rows pass the driver in blocks of hashes."""
    spark = counts.sparkSession
    word = counts.where((F.col("kind") == kind)).groupBy(F.lower("a").alias("a")).agg(F.sum("n").alias("n")).where(F.col("n") >= (LEAST if kind == "word" else 5 * LEAST))
    parts = {
        "words": word.select(F.xxhash64("a").alias("h"), "n", F.length("a").alias("size")),
        "pairs": counts.where((F.col("kind") == "pair") & (F.col("n") >= LEAST)).select(F.xxhash64("a", "b").alias("h"), "n", F.lit(0).alias("size")),
        "heads": counts.where((F.col("kind") == "head") & ~F.col("a").isin("", "#")).select(F.xxhash64("a").alias("h"), "n", F.lit(0).alias("size")),
    }
    folder = os.path.join(SparkFiles.getRootDirectory(), f"model-{uuid.uuid4().hex}")
    os.makedirs(folder)
    sizes, total, longest = [], 0, 0
    paths = [os.path.join(folder, n) for n in ARRAYS]
    for k, df in enumerate(parts.values()):
        df = checkpoint(df)
        facts = df.agg(F.count("*"), F.sum("n"), F.max("size")).first()
        if not k:
            total, longest = facts[1] or 0, facts[2] or 0
        blocks = max(1, -(-facts[0] // BLOCK))
        with open(paths[2 * k], "wb") as f, open(paths[2 * k + 1], "wb") as g:
            for b in range(blocks):  # a block is a range of hashes, unsigned
                low, high = ((-(-(i << 64) // blocks)) - (1 << 63) for i in (b, b + 1))
                shifted = F.col("h").bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))
                t = df.where((shifted >= low) & (shifted <= high - 1)).select("h", "n").toArrow()
                h = np.asarray(t.column(0), np.int64).view(np.uint64)
                order = np.argsort(h)
                f.write(h[order].tobytes())
                g.write(np.asarray(t.column(1), np.int64)[order].tobytes())
        sizes += [facts[0], facts[0]]
    name = f"{os.path.basename(folder)}.bin"
    with open(os.path.join(folder, name), "wb") as out:
        out.write(np.array(sizes, np.int64).tobytes())
        for path in paths:
            with open(path, "rb") as f:
                shutil.copyfileobj(f, out)
            os.remove(path)
    spark.sparkContext.addFile(os.path.join(folder, name))
    return name, total, longest


def read_model(name: str) -> tuple[Counts, Counts, Counts]:
    with open(SparkFiles.get(name), "rb") as f:
        m = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    at, out = 8 * len(ARRAYS), []
    for k, n in enumerate(np.frombuffer(m, np.int64, len(ARRAYS)).tolist()):
        kind = np.int64 if k % 2 else np.uint64
        out.append(np.frombuffer(m, kind, n, at) if n else np.zeros(0, kind))
        at += 8 * n
    return Counts(*out[:2]), Counts(*out[2:4]), Counts(*out[4:])


def build_model(elements: DataFrame, images: DataFrame) -> tuple:
    """What a worker needs for its model: name of the file, costs of confusions, sum and longest word."""
    first = F.coalesce(F.try_element_at("provenance", F.lit(1))["source"] == "layout", F.lit(False))
    prose = F.col("type").isin(*PROSE_TYPES) & F.col("id").isNotNull() & (F.length(F.trim("text")) > 0)
    head = F.col("type").isin("header", "footer")
    own = elements.where(F.length("text") > 0).select("text", (first & ~head & ~F.col("text").contains("\n")).alias("clean"), F.coalesce(prose, F.lit(False)).alias("scan"), F.coalesce(head, F.lit(False)).alias("head"))
    ocr = images.where(F.length(F.trim("ocr_text")) > 0).select(F.col("ocr_text").alias("text"), F.lit(False), F.lit(True), F.lit(False))
    counts = checkpoint(own.unionAll(ocr).mapInArrow(_count, "kind string, a string, b string, n bigint").groupBy("kind", "a", "b").agg(F.sum("n").alias("n")))
    digital = not counts.where((F.col("kind") == "word") & (F.col("n") >= LEAST)).isEmpty()
    name, total, longest = write_model(counts, "word" if digital else "scan")
    confusions = tuple(dict.fromkeys([*CONFUSIONS, *(learned_confusions(counts) if digital else [])]))
    rows = counts.where(F.col("kind") == "scan").select("a", "n").mapInArrow(_one_confusion(name, confusions), "s string, t string, n bigint").groupBy("s", "t").agg(F.sum("n").alias("n")).collect()
    seen = {(r[0], r[1]): r[2] for r in rows}
    weight = sum(seen.values()) + len(confusions)
    return name, {c: log((seen.get(c, 0) + 0.1) / weight) for c in confusions}, total, longest


def _repair_all(shared: tuple, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, costs, total, longest = shared
        model = Model(*read_model(name), costs, total, longest)
        for batch in batches:
            kinds, ids, out = [], [], []
            for kind, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = text.split()
                if model.fine.issuperset(tokens) and not LINE.search(text):
                    fixed, noise = " ".join(tokens), ()
                else:
                    fixed, noise = repair(text, model)
                for x in [fixed] if texts else sorted(noise):
                    kinds.append(kind)
                    ids.append(key)
                    out.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(ids, pa.string()), pa.array(out, pa.string())], names=["record_kind", "record_id", "text" if texts else "noise"])

    return run


def found(elements: DataFrame, images: DataFrame) -> DataFrame:
    """record_kind, record_id, noise."""
    model = build_model(elements, images)
    return records(elements, images).mapInArrow(_repair_all(model, False), "record_kind string, record_id string, noise string").distinct()


def repaired(elements: DataFrame, images: DataFrame) -> DataFrame:
    """record_kind, record_id, text: the readable text of every paragraph, list item and text of an image."""
    model = build_model(elements, images)
    return records(elements, images).mapInArrow(_repair_all(model, True), "record_kind string, record_id string, text string").distinct()
