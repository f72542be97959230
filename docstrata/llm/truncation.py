"""Text cut off by field limits or in transfer (problem 1), in SQL.

Every token trigram (words, marks and sentence breaks; numbers and tags of
instruments are one token) is counted over all captions: how often it stands somewhere, how often a
text, or a sentence with its mark, ends with it. The final trigram of each text is joined with
these counts; one that is frequent inside but almost never last marks a cut. The share of ends
is smoothed, not switched: a trigram backs off to its pair and its last token, each weighing as
BACKOFF occurrences for the next longer one. A last word that may itself be cut short is asked a
second time as "any word" after the two tokens before it; the smaller share decides.

Labels end without a mark by nature. Where sentences that open with the same two tokens (neither being
the last) mostly do, the same trigram shares are taken among the unmarked sentences of that opening. Openings
decide only ties: an unmarked text with a share between SHARE and TIE is cut if sentences of its
opening mostly end in a mark. The trace of a cut transfer (an unfinished tag, entity or escape, an
ellipsis) is taken off first, and the trigram before it decides.

Copies of a text inside a document count once. Nothing but shares decides, so more rows of the
same kind change nothing.

Results: null, empty and blank captions are not cut; residue (problem 2) is taken out by a join in
found() and report(); a repeated row counts as one image; a null source is a group of its own
in the report; ids null: left out. A caption cut exactly behind a whole sentence is not found.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.runtime import checkpoint

#: A final trigram with a smaller share of ends is a cut; up to TIE the opening decides.
SHARE, TIE = 0.04, 0.5
#: So many occurrences weighs what is known of the next shorter gram, and the share without any knowledge.
BACKOFF, PRIOR = 4.0, 0.05
#: The share of a single token needs more of them: with none among so many an end is still likely.
SINGLE = 25.0
#: Occurrences from which a last word is known as a whole one, and an opening as an opening.
KNOWN, OPENING_MIN = 4, 5
#: Final keys of more than one in HOT rows are joined by broadcast: at most HOT * SLOTS rows.
HOT = 1000

TRACE = r"(<[/!]?\w{0,12}|&#?\w{1,8}|\\(u[0-9a-fA-F]{0,4}|x[0-9a-fA-F]{0,2})?|\[[.…]{0,3}|[.]{2,}|…|�)$"
DONE = r'[.!?]["“”’)\]\s]*$'
TOKEN = r"\p{L}[\p{L}\p{N}\x27’-]*|0|[^\s\p{L}\p{N}\"“’]"

#: Texts without decoration and trace, and their tokens; '¶' stands where a sentence begins. What is asked of the ends is
#: asked of the first and last characters only.
TEXTS = r"""
SELECT id, document_id, caption_source, concat(regexp_replace(left(body, 4), r'^([*"] ?|<p>)', ''), substring(body, 5, length(body) - 4 - least(24, length(body) - 4)),
    rtrim(regexp_replace(regexp_replace(right(body, greatest(0, least(24, length(body) - 4))), r'( ?[*]|</p>)$|(?<=[.”)])"$', ''), r'{trace}', ''))) AS text
FROM (SELECT *, trim(BOTH ' 	
' FROM caption) AS body FROM {captions}) WHERE id IS NOT NULL AND length(body) > 0
"""
TOKENS = r"""
SELECT *, size(words) AS n, coalesce(nullif(size(words) + 1 - array_position(reverse(words), '¶'), size(words) + 1), 0) AS s FROM (
  SELECT id, caption_source, xxhash64(document_id, text) AS copy, right(text, 24) RLIKE r'{done}' AND NOT right(text, 24) RLIKE r'\s[\d.,]*\d\.$' AS done,
    regexp_extract_all(lower(regexp_replace(regexp_replace(text, r'(?<=[.!?]["”’)]?)\s+(?=[\p{Lu}“"])', ' ¶ '), r'(?<!\p{L})(?:\p{L}++-)?\d+([.,]\d*)*', '0')), r'{token}', 0) AS words
  FROM {texts}
)
"""
#: A word: its first letter is one (marks between U+2000 and U+2BFF are none).
WORD = "(c >= 'a' AND c < '\\u007b' OR c >= 'À' AND c < '\u2000' OR c >= '\u2c00')"
#: Trigrams, pairs and single tokens, and 'any word' after two tokens and one; o is the opening or 0.
KEYS = f"""xxhash64(3, {{o}}, a, b, c), IF({WORD}, xxhash64(4, {{o}}, a, b), NULL), xxhash64(2, {{o}}, b, c), IF({WORD}, xxhash64(5, {{o}}, b), NULL), xxhash64(1, {{o}}, c)"""
PLACES = """
SELECT *, get(words, i - 2) AS a, get(words, i - 1) AS b, words[i] AS c,
  i = n - 1 OR words[i + 1] = '¶' AS last,
  IF(n - s > 2, xxhash64(6, words[s], words[s + 1]), NULL) AS o
FROM (SELECT copy, done, words, n, s, {row} explode({places}) AS i FROM {tokens})
"""
#: How often every key stands in the texts, and how often a text or a sentence with its mark ends there.
COUNTS = f"""
SELECT key, count(*) AS n, count_if(last) AS t FROM (
  SELECT explode(concat(
    array({KEYS.format(o="0")}),
    IF(NOT done AND o IS NOT NULL AND i >= s, array({KEYS.format(o="o")}, xxhash64(0, o)), array()),
    IF(i < n - 1 AND (i = 0 OR b = '¶'), array(xxhash64(6, c, words[i + 1]), IF(NOT done AND i = s, xxhash64(7, xxhash64(6, c, words[i + 1])), NULL)), array()))) AS key, last
  FROM {{places}}
) WHERE key IS NOT NULL GROUP BY key
"""
SLOTS = ["u3", "uf3", "u2", "uf2", "u1", "l3", "lf3", "l2", "lf2", "l1", "l0", "op", "unmarked"]
#: The keys of the last place of each text.
FINAL = f"""
SELECT row_id, IF(slot = 0, id, NULL) AS id, IF(slot = 0, caption_source, NULL) AS caption_source, done, word, slot, key FROM (SELECT row_id, id, caption_source, done, word, posexplode(keys) AS (slot, key) FROM (
  SELECT row_id, id, caption_source, done, {WORD} AS word, concat(array({KEYS.format(o="0")}),
    IF(NOT done AND o IS NOT NULL, array({KEYS.format(o="o")}, xxhash64(0, o), o, xxhash64(7, o)), array())) AS keys FROM {{places}}
))
"""
LOOKED_UP = """
SELECT max(id) AS id, max(caption_source) AS caption_source, first(done) AS done, first(word) AS word, {slots} FROM {{keys}} GROUP BY row_id
""".format(slots=", ".join(f"max(IF(slot = {i}, n, NULL)) AS n_{s}, max(IF(slot = {i}, t, NULL)) AS t_{s}" for i, s in enumerate(SLOTS)))


def _smoothed(set_: str, prior: str) -> str:
    """Shares of ends without the text itself, for the last token as it is and as any word."""
    share = lambda g, back, weight=BACKOFF: f"(greatest(t_{set_}{g} - 1, 0) + {weight}D * ({back})) / (greatest(n_{set_}{g} - 1, 0) + {weight}D)"
    own = share("3", share("2", share("1", prior, SINGLE)))
    word = share("f3", share("f2", prior))
    return f"CASE WHEN NOT word THEN {own} WHEN n_{set_}1 - 1 >= {KNOWN} THEN least({own}, {word}) ELSE {word} END"


SHARES = f"""
SELECT id, caption_source, done, n_u3 AS n, t_u3 AS t, unmarked_share, IF(unmarked_share > 0.5D, {_smoothed("l", "t_l0 / n_l0")}, {_smoothed("u", f"{PRIOR}D")}) AS end_share FROM (
  SELECT *, IF(n_op >= {OPENING_MIN}, coalesce(n_unmarked, 0) / n_op, NULL) AS unmarked_share FROM {{rows}}
)
"""
DECIDED = f"""
SELECT *, end_share <= {SHARE}D OR (NOT done AND end_share < {TIE}D AND coalesce(unmarked_share < 0.5D, FALSE)) AS cut FROM {{shares}}
"""


def _sql(spark: SparkSession, query: str, **values) -> DataFrame:
    """Run a query whose {names} are frames or constants."""
    views = []
    for name, value in values.items():
        if isinstance(value, DataFrame):
            view = f"docstrata_{uuid.uuid4().hex}"
            value.createOrReplaceTempView(view)
            views.append(view)
            value = view
        query = query.replace("{%s}" % name, str(value))
    out = spark.sql(query)
    for view in views:
        spark.catalog.dropTempView(view)
    return out


def _looked_up(finals: DataFrame, counts: DataFrame) -> DataFrame:
    """finals with the counts of their keys. A mark that ends most texts is one key of most rows:
    keys of more than one in HOT rows go by broadcast, which HOT bounds, all others by shuffle."""
    often = finals.groupBy("key").agg(F.count("*").alias("rows"))
    total = finals.count()
    hot = F.broadcast(often.where(F.col("rows") > F.lit(total / HOT)).join(counts, "key").select("key", F.col("n").alias("hot_n"), F.col("t").alias("hot_t")))
    marked = finals.join(hot, "key", "left")
    rest = marked.where(F.col("hot_n").isNull()).drop("hot_n", "hot_t").join(counts, "key", "left")
    return marked.where(F.col("hot_n").isNotNull()).withColumnsRenamed({"hot_n": "n", "hot_t": "t"}).unionByName(rest)


def decisions(captions: DataFrame) -> DataFrame:
    """captions: id, document_id, caption_source, caption. id, caption_source, done (ends with a mark),
    n and t (occurrences of the final trigram, and at ends), unmarked_share of the opening, end_share, cut."""
    spark = captions.sparkSession
    tokens = checkpoint(_sql(spark, TOKENS, texts=_sql(spark, TEXTS, captions=captions, trace=TRACE), done=DONE, token=TOKEN).withColumn("row_id", F.monotonically_increasing_id())).where("n > 0")  # asked of the stored tokens: below the table it would tokenise twice
    once = tokens.groupBy("copy").agg(F.first(F.struct("done", "words", "n", "s")).alias("r")).select("copy", "r.*")
    counts = checkpoint(_sql(spark, COUNTS, places=_sql(spark, PLACES, tokens=once, row="", places="sequence(0, n - 1)")))
    places = _sql(spark, PLACES, tokens=tokens, row="row_id, id, caption_source,", places="array(n - 1)")
    finals = checkpoint(_sql(spark, FINAL, places=places))
    rows = _sql(spark, LOOKED_UP, keys=_looked_up(finals, counts))
    return _sql(spark, DECIDED, shares=_sql(spark, SHARES, rows=rows))


def found(captions: DataFrame, residue: DataFrame) -> DataFrame:
    """image_id of cut captions that are not among those of residue (image_id)."""
    return decisions(captions).where("cut").select(F.col("id").alias("image_id")).distinct().join(residue, "image_id", "left_anti")


def report(captions: DataFrame, residue: DataFrame) -> DataFrame:
    """caption_source, n_captions, n_cut, cut_share: per source, over captions with text that are no residue."""
    each = decisions(captions).groupBy("id", "caption_source").agg(F.max(F.col("cut").cast("int")).alias("cut")).withColumnRenamed("id", "image_id")
    kept = each.join(residue, "image_id", "left_anti")
    return kept.groupBy("caption_source").agg(F.count("*").alias("n_captions"), F.sum("cut").alias("n_cut")).withColumn("cut_share", F.round(F.col("n_cut") / F.col("n_captions"), 6))
