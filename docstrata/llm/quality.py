"""Text quality statistics that tell natural prose from lists, tables and junk (problem 10).

Running sentences are recognised by common words of several languages (or, outside the Latin
script, by letters and sentence marks); lines in which names and numbers prevail are none. All other
lines are told apart by layout, together with ratios of words and symbols:

* vertical delimiter alignment: equal numbers of one delimiter, or blanks in the same columns, on
  neighbouring lines make a table;
* indentation periodicity: how often the opening of a line (its indentation and what stands before its
  first word: a bullet, number, label, command) returns after one to six lines. Entries of any length
  with a periodic opening are a list;
* line-length autocorrelation: lines of constant length are a table if columns of blanks run through
  them, else junk (encoded or filled data); lengths that follow each other make unmarked lines a list.

Lines of few words without such a layout are a list as well (short entries), as are lines of names
and numbers (references). Lines that are hardly words (encoded, garbled, bare commands) and lines whose
form, digits aside, returns more than twice (logs, repeated fragments) are junk. A text of which running
sentences make up less than PROSE_SHARE of the characters gets the class that prevails.

Results: one row of statistics per document; null, empty and blank texts have zero counts,
null ratios and no class. Repeated documents give repeated rows. Whole texts are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROSE_SHARE = 0.2
COMMON_SHARE = 0.15
WORDS_IN_SENTENCE = 6
#: From this share of its tokens names and numbers make a line an entry, not a sentence.
NAMES_SHARE = 0.5
#: A line with more capitals than this is set in capitals or as a title: they tell nothing.
CAPITALS = 0.9
#: Characters in plain words, and tokens that are plain, of a line that is words at all.
WORDS_SHARE, PLAIN_SHARE = 0.4, 0.6
#: The mean entry of an unmarked list has at most so many words.
SHORT = 8
#: A layout shows from so many lines on, and from such a share or autocorrelation; that of lengths
#: must also be over CHANCE standard errors.
LAYOUT_LINES, LAYOUT, CHANCE = 4, 0.5, 2.5
PERIODS, LAGS = range(1, 7), range(1, 4)

WORD = re.compile(r"[^\W\d_]+")
COMMAND = re.compile(r"\\[A-Za-z@]+\*?")
MATH = re.compile(r"\$[^$\n]*\$|\\[A-Za-z@]+\*?(?:\[[^\]\n]*\])?")
SYMBOL = re.compile(r"[^\w\s]|_")
LINES = re.compile(r"[\r\n\u2028\x0b\x0c]+")
#: What stands before the first word of an entry: marks, numbers, a single letter, a formula, a command with its label.
OPENING = re.compile(r"(?:\$[^$\n]*\$|\\[A-Za-z@]+\*?(?:[\[{][^\]}\n]*[\]}])?|\d+|[A-Za-z](?=[.)\]])|[^\w\s$\\]|[$\\]|\s)*")
DIGITS, LETTERS, BULLETS = re.compile(r"\d+"), re.compile(r"[^\W\d_]+"), re.compile(r"[-*+•‣◦·–—]+")
GAP = re.compile(r"(?<=\S)(?: {2,}|\t+)(?=\S)")
TIGHT_COMMA = re.compile(r",(?=\S)")
FOREIGN = re.compile(r"[Ͱ-῿぀-鿿가-힯]")
ALNUM = re.compile(r"[^\W_]")
RAISED = re.compile(r"\b[A-ZÀ-Þ\d]")
STOPS = re.compile(r"[.!?。！？؟।]")
END = re.compile(r"[.!?…:;。！？]['\"”’)\]]*$")
PLAIN = re.compile(r"[({\[]*(?:[^\W\d_]{1,40}(?:[-/'’.][^\W\d_]{1,40})*|\d[\d.,:/–-]*)[,.:;)}\]]*")
CLASSES = ("list", "table", "junk")


def columns_of(line: str) -> tuple[str, int]:
    """The delimiter that cuts a line into columns, and how often it does."""
    for mark in ("&", "|", "\t"):
        n = line.count(mark)
        if n:
            return mark, n
    if "," in line and ", " not in line:
        n = len(TIGHT_COMMA.findall(line))
        if n:
            return ",", n
    n = line.count(";")
    if n >= 2 and "; " not in line:
        return ";", n
    gaps = len(GAP.findall(line)) if "  " in line else 0
    return ("gap", gaps) if gaps else ("", 0)


def autocorrelation(x: np.ndarray, lags: range) -> float:
    """The largest autocorrelation of a sequence over some lags; 1 if it is constant."""
    if len(x) < 4:
        return 0.0
    x = x - x.mean()
    total = float((x * x).sum())
    if total == 0:
        return 1.0
    return max((float((x[k:] * x[:-k]).sum()) / total for k in lags if k < len(x) - 1), default=0.0)


def opening(line: str) -> str:
    """The form of what stands before a line's first word: its indentation, marks and labels."""
    indent = len(line) - len(line.lstrip())
    head = OPENING.match(line.strip())[0].rstrip()
    if head:
        head = BULLETS.sub("-", LETTERS.sub("a", DIGITS.sub("0", re.sub(r"\[[^\]]*\]|\{[^}]*\}|\$[^$]*\$", "[]", head))))
    return f"{indent}{head}" if head or indent else ""


def periodicity(openings: list[str]) -> float:
    """The largest share of lines that open like the one some lines before, where lines of the period open at all."""
    n = len(openings)
    best = 0.0
    for p in PERIODS:
        if n >= max(LAYOUT_LINES, p + 2):
            same = sum(a == b for a, b in zip(openings[p:], openings))
            marked = sum(bool(a) for a in openings)
            if marked * p >= 0.5 * n:
                best = max(best, same / (n - p))
    return best


def names_and_numbers(tokens: list[str]) -> float:
    """The share of tokens that are numbers or, behind the first, begin with a capital."""
    if not tokens:
        return 0.0
    numbers, capitals = sum(t[0].isdigit() for t in tokens), sum(t[0].isupper() for t in tokens[1:])
    return (numbers + (capitals if numbers + capitals < CAPITALS * len(tokens) else 0)) / len(tokens)


def plain_words(line: str) -> bool:
    """Whether a line is mostly separate words and numbers, not encoded, garbled or bare commands."""
    bare = COMMAND.sub(" ", line) if "\\" in line else line
    words = [t for t in bare.split() if ALNUM.search(t)]
    if len(words) == 1 and len(words[0]) > 30:
        return False
    plain = [t for t in words if PLAIN.fullmatch(t)]
    letters = sum(len(w) for w in WORD.findall(" ".join(plain)) if len(w) > 1)
    numbers = sum(len(t) for t in plain if t[0].isdigit()) if letters else 0
    return letters + numbers >= WORDS_SHARE * len(line.replace(" ", "")) and len(plain) >= PLAIN_SHARE * len(words)


def layout(lines: list[str]) -> tuple[str, float, float]:
    """The class of lines of words that no delimiter aligns, with indentation periodicity and line-length autocorrelation."""
    stripped = [s.strip() for s in lines]
    length = np.array([len(s) for s in stripped], float)
    period, follow = periodicity([opening(s) for s in lines]), autocorrelation(length, LAGS)
    words = sum(len(s.split()) for s in stripped) / len(lines)
    if len(lines) >= LAYOUT_LINES:
        if not np.ptp(length):
            columns = set.intersection(*({m.start() for m in re.finditer(r"\s", s)} for s in stripped))
            return ("table" if columns else "junk"), period, follow
        if period >= LAYOUT or follow >= max(LAYOUT, CHANCE / len(lines) ** 0.5):
            return "list", period, follow
    entry = words <= SHORT and len(lines) > 1 or np.mean([names_and_numbers(s.split()) for s in stripped]) >= NAMES_SHARE
    return ("list" if entry else "junk"), period, follow


def analyse(text: str, common: frozenset, only_class: bool = False) -> dict:
    """Statistics and class of one text that isn't blank. only_class: nothing but the class, which leaves
    the other lines of a text alone once its sentences make it prose."""
    lines = [s for s in LINES.split(text.lstrip("\ufeff")) if s.strip()]
    weight = [len(s.strip()) for s in lines]
    n_words = letters = common_n = ends = 0
    kinds = [""] * len(lines)
    rest: list[int] = []
    shape: Counter = Counter()
    counts, keys = {}, {}
    for i, raw in enumerate(lines):
        s = raw.strip()
        words = WORD.findall(s.lower())
        n_words += len(words)
        letters += sum(map(len, words))
        hits = sum(map(common.__contains__, words))
        common_n += hits
        ends += bool(END.search(s[-8:]))
        if len(words) >= WORDS_IN_SENTENCE and hits >= COMMON_SHARE * WORDS_IN_SENTENCE:
            if "\\" in s or "$" in s:
                bare = MATH.sub(" ", s)
                plain = WORD.findall(bare.lower())
                hits = sum(map(common.__contains__, plain))
            else:
                bare, plain = s, words
            if len(plain) >= WORDS_IN_SENTENCE and hits >= COMMON_SHARE * len(plain) and (len(RAISED.findall(bare)) < NAMES_SHARE * len(plain) or names_and_numbers(re.findall(r"\w+", bare)) < NAMES_SHARE):
                kinds[i] = "prose"
                continue
        if len(s) >= 20 and FOREIGN.search(s) and len(FOREIGN.findall(s)) >= 0.5 * len(s.replace(" ", "")) and STOPS.search(s):
            kinds[i] = "prose"
            continue
        rest.append(i)
        counts[i] = columns_of(s)
        keys[i] = DIGITS.sub("0", s)
        shape[keys[i]] += 1
    total = sum(weight)
    if only_class and sum(w for k, w in zip(kinds, weight) if k) >= PROSE_SHARE * total:
        return {"text_class": None}
    aligned = 0
    entries: list[int] = []
    for j, i in enumerate(rest):
        s = lines[i].strip()
        mark, n = counts[i]
        near = [counts[rest[k]] for k in (j - 1, j + 1) if 0 <= k < len(rest)]
        beside = n > 0 and (mark, n) in near and (mark not in (",", "gap") or n >= 2 or shape[keys[i]] < 3)
        tokens = s.split()
        same = len(tokens) >= 4 and len(set(tokens)) <= 2
        dense = len(ALNUM.findall(s)) / len(s.replace(" ", "")) if n else 0.0
        if beside and dense >= 0.3 and not COMMAND.match(s) and not same:
            aligned += 1
            kinds[i] = "table"
        elif shape[keys[i]] > 2 or not WORD.search(s) or same:
            kinds[i] = "junk"
        elif 0 < n <= 40 and mark in ("&", "|", "\t") and dense >= 0.5:
            kinds[i] = "table"
        elif plain_words(s):
            entries.append(i)
        else:
            kinds[i] = "frame" if COMMAND.match(s) and len(rest) > 1 else "junk"
    period = follow = 0.0
    if entries:
        kind, period, follow = layout([lines[i] for i in entries])
        for i in entries:
            kinds[i] = kind
    by = Counter()
    for k, w in zip(kinds, weight):
        by[k] += w
    if by["frame"] >= by["list"] + by["table"]:  # commands around entries frame them; by themselves they are junk
        by["junk"] += by.pop("frame", 0)
    prose = by["prose"] / total
    text_class = None
    if prose < PROSE_SHARE:
        best = max(CLASSES, key=lambda k: by[k])
        text_class = best if by[best] else "junk"
    return {
        "n_lines": len(lines), "n_words": n_words, "mean_word_length": letters / n_words if n_words else 0.0, "symbol_ratio": len(SYMBOL.findall(text.lstrip("\ufeff"))) / total,
        "end_punctuation_share": ends / len(lines), "common_word_share": common_n / n_words if n_words else 0.0,
        "prose_share": prose, "list_share": by["list"] / total, "table_share": by["table"] / total, "junk_share": by["junk"] / total,
        "delimiter_alignment": aligned / len(lines), "indent_periodicity": period, "line_length_autocorrelation": follow, "text_class": text_class,
    }


FIELDS = {
    "n_lines": pa.int64(), "n_words": pa.int64(), "mean_word_length": pa.float64(), "symbol_ratio": pa.float64(), "end_punctuation_share": pa.float64(), "common_word_share": pa.float64(), "prose_share": pa.float64(),
    "list_share": pa.float64(), "table_share": pa.float64(), "junk_share": pa.float64(), "delimiter_alignment": pa.float64(), "indent_periodicity": pa.float64(), "line_length_autocorrelation": pa.float64(), "text_class": pa.string(),
}
SCHEMA = "doc_id bigint, n_lines bigint, n_words bigint, mean_word_length double, symbol_ratio double, end_punctuation_share double, common_word_share double, prose_share double, list_share double, table_share double, junk_share double, delimiter_alignment double, indent_periodicity double, line_length_autocorrelation double, text_class string"
#: White space and the byte order mark.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000\ufeff" + "".join(map(chr, range(0x2000, 0x200B)))
BLANK = {k: 0 if v == pa.int64() else None for k, v in FIELDS.items()}


def _common(common_words: DataFrame) -> frozenset:
    # The word lists of a few languages, fixed in size: a parameter of the operator, not data of the corpus.
    return frozenset(r[0] for r in common_words.select(F.lower("word")).where(F.col("word").isNotNull()).distinct().collect())


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def statistics(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """One row of SCHEMA per document."""
    common = _common(common_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [analyse(t, common) if t is not None and t.strip(BLANKS) else BLANK for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in rows], kind) for k, kind in FIELDS.items()]], names=["doc_id", *FIELDS])

    return _rows(documents).mapInArrow(run, SCHEMA)


def found(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """doc_id, text_class of texts that are hardly prose."""
    common = _common(common_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [analyse(t, common, True)["text_class"] if t is not None and t.strip(BLANKS) else None for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kinds, pa.string())], names=["doc_id", "text_class"])

    return _rows(documents).mapInArrow(run, "doc_id bigint, text_class string").where(F.col("text_class").isNotNull()).distinct()
