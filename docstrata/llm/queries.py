"""Queries of the text problems and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docstrata.llm import leaks, neardup, pieces, quality, residue, scans, tokenize, truncation
from docstrata.runtime import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    images = table(spark, d, "image_assets")
    return truncation.found(images, residue.found(images))


def p1_source_report(spark: SparkSession, d: str) -> DataFrame:
    images = table(spark, d, "image_assets")
    return truncation.report(images, residue.found(images))


def p1_ends(spark: SparkSession, d: str) -> DataFrame:
    """How the final trigram of every caption, residue included, decides."""
    rows = truncation.decisions(table(spark, d, "image_assets"))
    return rows.select(F.col("id").alias("image_id"), "n", "t", F.round("end_share", 9).alias("end_share"), "cut").distinct()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.found(table(spark, d, "image_assets"))


def p2_kept(spark: SparkSession, d: str) -> DataFrame:
    return residue.kept(table(spark, d, "image_assets"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.found(table(spark, d, "canonical_elements"), table(spark, d, "image_assets"))


def p3_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scans.repaired(table(spark, d, "canonical_elements"), table(spark, d, "image_assets"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.found(table(spark, d, "canonical_elements"), table(spark, d, "image_assets"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.groups(table(spark, d, "canonical_elements"), table(spark, d, "image_assets"))


def p5_copies(spark: SparkSession, d: str) -> DataFrame:
    return neardup.copies(table(spark, d, "canonical_elements"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return pieces.found(table(spark, d, "canonical_elements"))


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.pieces(table(spark, d, "canonical_elements"))


def p6_sizes(spark: SparkSession, d: str) -> DataFrame:
    """The characters of every item as its pieces give them without their overlaps, and whether each piece keeps its limit."""
    made = p6_pieces(spark, d)
    limit = F.when(F.col("item_kind") == "element", pieces.ELEMENT_LIMIT).otherwise(pieces.SECTION_LIMIT)
    rows = made.groupBy("item_kind", "item_id").agg(F.sum(F.length("text") - F.col("overlap")).alias("size"), F.max(F.length("text") > limit).alias("over"), F.max("overlap").alias("overlap"), F.count("*").alias("n"), F.max("n_pieces").alias("m"), F.max("piece").alias("last"))
    return rows.select("item_kind", "item_id", "size", (~F.col("over") & (F.col("overlap") <= pieces.OVERLAP) & (F.col("n") == F.col("m")) & (F.col("last") == F.col("n") - 1)).alias("sound"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Every test item with the number of documents that hold a passage of it."""
    items = table(spark, d, "eval_items")
    n = leaks.leaks(table(spark, d, "documents"), items).groupBy("item_id").agg(F.count("*").alias("n_documents"))
    return items.select("item_id", "suite").join(n, "item_id", "left").withColumn("n_documents", F.coalesce("n_documents", F.lit(0)))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.found(table(spark, d, "documents"), table(spark, d, "common_words"))


def p10_statistics(spark: SparkSession, d: str) -> DataFrame:
    return quality.statistics(table(spark, d, "documents"), table(spark, d, "common_words"))


def p10_ratios(spark: SparkSession, d: str) -> DataFrame:
    """The ratios of p10_statistics, which SQL can express."""
    rows = p10_statistics(spark, d)
    return rows.select("doc_id", "n_lines", "n_words", *[F.round(c, 6).alias(c) for c in ("mean_word_length", "symbol_ratio", "end_punctuation_share", "common_word_share")])


NAMES = "p1_found p1_source_report p1_ends p2_found p2_kept p3_found p3_repaired p5_found p5_groups p5_copies p6_found p6_pieces p6_sizes p8_ids p9_found p9_items p10_found p10_statistics p10_ratios".split()


def queries() -> dict[str, Query]:
    return {name: globals()[name] for name in NAMES}


ONE_ROW = """SELECT id, max_by(coalesce(document_id, ''), coalesce(loaded_at, TIMESTAMP '1900-01-01')) AS document_id,
  max_by(reading_order, coalesce(loaded_at, TIMESTAMP '1900-01-01')) AS pos, max_by(coalesce(heading_level, -1), coalesce(loaded_at, TIMESTAMP '1900-01-01')) >= 0 AS heading,
  max_by(length(coalesce(text, '')), coalesce(loaded_at, TIMESTAMP '1900-01-01')) AS size FROM canonical_elements WHERE id IS NOT NULL GROUP BY id"""


LEAKS = r"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(regexp_replace(text, '\\[A-Za-z]+', ' ', 'g')), '[\p{L}\p{N}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(regexp_replace(text, '\\[A-Za-z]+', ' ', 'g')), '[\p{L}\p{N}]+') AS w FROM eval_items),
dg AS (SELECT doc_id, w[k:k + 12] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d)),
ig AS (SELECT item_id, w[k:k + 12] AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS k FROM i)),
leak AS (SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g))"""


_share = lambda n, t, back, weight: f"(greatest({t} - 1, 0) + {weight}::DOUBLE * ({back})) / (greatest({n} - 1, 0) + {weight}::DOUBLE)"


def _end_share(s: str, prior: str) -> str:
    own = _share(f"n{s}3", f"t{s}3", _share(f"n{s}2", f"t{s}2", _share(f"n{s}1", f"t{s}1", prior, truncation.SINGLE), truncation.BACKOFF), truncation.BACKOFF)
    word = _share(f"n{s}5", f"t{s}5", _share(f"n{s}4", f"t{s}4", prior, truncation.BACKOFF), truncation.BACKOFF)
    return f"CASE WHEN NOT word THEN {own} WHEN n{s}1 - 1 >= {truncation.KNOWN} THEN least({own}, {word}) ELSE {word} END"


_GRAMS = ["a || chr(1) || b || chr(1) || c", "b || chr(1) || c", "c", "CASE WHEN word THEN b END", "CASE WHEN word THEN a || chr(1) || b END"]
_numbered = lambda s, prefix: ", ".join(f"{s}{i}.n AS n{prefix}{k}, {s}{i}.t AS t{prefix}{k}" for i, k in enumerate((3, 2, 1, 4, 5)))
_joined = lambda s, side, key: " ".join(f"LEFT JOIN {side}{i} {s}{i} ON {s}{i}.key = {key}({g})" for i, g in enumerate(_GRAMS))
#: The counts of every gram as own tables; string keys instead of hashes.
ENDS = r"""WITH body AS (SELECT *, trim(caption, ' ' || chr(9) || chr(10) || chr(13)) AS body FROM image_assets WHERE id IS NOT NULL),
base AS (SELECT id, document_id, regexp_replace(left(body, 4), '^([*"] ?|<p>)', '') || substring(body, 5, greatest(0, length(body) - 28)) || rtrim(regexp_replace(regexp_replace(regexp_replace(CASE WHEN length(body) > 4 THEN right(body, least(24, length(body) - 4)) ELSE '' END, '( ?[*]|</p>)$', ''), '([.”)])"$', '\1'), '%s', '')) AS text FROM body WHERE length(body) > 0),
cut AS (SELECT id, document_id, text, regexp_matches(right(text, 24), '%s') AND NOT regexp_matches(right(text, 24), '\s[\d.,]*\d\.$') AS done, regexp_extract_all(lower(regexp_replace(regexp_replace(text, '([.!?]["”’)]?)\s+([\p{Lu}“"])', '\1 ¶ \2', 'g'), '(\p{L}+-)?\d+([.,]\d*)*', '0', 'g')), '%s') AS words FROM base WHERE text <> ''),
toks AS (SELECT *, len(words) AS n, CASE WHEN list_position(list_reverse(words), '¶') IS NULL THEN 1 ELSE len(words) + 2 - list_position(list_reverse(words), '¶') END AS s FROM cut WHERE len(words) > 0),
spots AS (SELECT *, coalesce(words[i - 2], '') AS a, coalesce(words[i - 1], '') AS b, words[i] AS c, regexp_matches(words[i], '^\p{L}') AS word, i = n OR words[i + 1] = '¶' AS last, CASE WHEN n > s + 1 THEN words[s] || chr(1) || words[s + 1] END AS o FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM (SELECT done, words, n, s FROM toks GROUP BY document_id, text, done, words, n, s))),
fin AS (SELECT id, done, n, s, words, coalesce(words[n - 2], '') AS a, coalesce(words[n - 1], '') AS b, words[n] AS c, regexp_matches(words[n], '^\p{L}') AS word, CASE WHEN n > s + 1 THEN words[s] || chr(1) || words[s + 1] END AS o FROM toks),
lab AS (SELECT *, o || chr(2) AS p FROM spots WHERE NOT done AND o IS NOT NULL AND i >= s),
op AS (SELECT words[i] || chr(1) || words[i + 1] AS key, count(*) AS n, count(*) FILTER (WHERE NOT done AND i = s) AS t FROM spots WHERE i < n AND (i = 1 OR b = '¶') GROUP BY 1),
lt AS (SELECT o AS key, count(*) AS n, count(*) FILTER (WHERE last) AS t FROM lab GROUP BY 1)""" % (truncation.TRACE, truncation.DONE, truncation.TOKEN)
ENDS += "".join(f",\nu{i} AS MATERIALIZED (SELECT {g} AS key, count(*) AS n, count(*) FILTER (WHERE last) AS t FROM spots GROUP BY 1),\nl{i} AS MATERIALIZED (SELECT p || ({g}) AS key, count(*) AS n, count(*) FILTER (WHERE last) AS t FROM lab GROUP BY 1)" for i, g in enumerate(_GRAMS))
ENDS += f""",
found AS (SELECT f.id, f.done, f.word, {_numbered("ju", "u")}, {_numbered("jl", "l")}, lt.t AS tl0, lt.n AS nl0, CASE WHEN op.n >= {truncation.OPENING_MIN} THEN op.t / op.n END AS unmarked
  FROM fin f {_joined("ju", "u", "")} {_joined("jl", "l", "f.o || chr(2) || ")} LEFT JOIN lt ON lt.key = f.o AND NOT f.done LEFT JOIN op ON op.key = f.o AND NOT f.done),
shares AS (SELECT id, done, nu3, tu3, unmarked, CASE WHEN unmarked > 0.5 THEN {_end_share("l", "tl0 / nl0")} ELSE {_end_share("u", f"{truncation.PRIOR}::DOUBLE")} END AS share FROM found)
SELECT DISTINCT id AS image_id, nu3 AS n, tu3 AS t, round(share, 9) AS end_share, share <= {truncation.SHARE} OR (NOT done AND share < {truncation.TIE} AND coalesce(unmarked < 0.5, false)) AS cut FROM shares"""


SPACE = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
RATIOS = rf"""WITH t AS (SELECT doc_id, ltrim(text, chr(65279)) AS text FROM documents),
l AS (SELECT *, list_filter(list_transform(regexp_split_to_array(text, '[\r\n\x{{2028}}\x0b\x0c]+'), lambda x: regexp_replace(x, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')), lambda x: x <> '') AS lines FROM t),
w AS (SELECT *, list_sum(list_transform(lines, lambda x: length(x))) AS size, regexp_extract_all(lower(array_to_string(lines, chr(10))), '[\p{{L}}\p{{Nl}}\p{{No}}]+') AS words FROM l)
SELECT doc_id, coalesce(len(lines), 0) AS n_lines, coalesce(len(words), 0) AS n_words, CASE WHEN len(lines) > 0 THEN round(CASE WHEN len(words) = 0 THEN 0.0 ELSE list_sum(list_transform(words, lambda x: length(x)))::DOUBLE / len(words) END, 6) END AS mean_word_length,
  CASE WHEN len(lines) > 0 THEN round(len(regexp_extract_all(text, '[^\p{{L}}\p{{N}}{SPACE}]'))::DOUBLE / size, 6) END AS symbol_ratio, CASE WHEN len(lines) > 0 THEN round(len(list_filter(lines, lambda x: regexp_matches(right(x, 8), '[.!?…:;。！？][\x27"”’)\]]*$')))::DOUBLE / len(lines), 6) END AS end_punctuation_share,
  CASE WHEN len(lines) > 0 THEN round(CASE WHEN len(words) = 0 THEN 0.0 ELSE len(list_filter(words, lambda x: list_contains(common, x)))::DOUBLE / len(words) END, 6) END AS common_word_share FROM w CROSS JOIN (SELECT list(DISTINCT lower(word)) AS common FROM common_words)"""


#: All pairs that share a sequence, and all pairs of hashes: for small tables.
PAIRS = rf"""WITH e AS (SELECT DISTINCT id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM canonical_elements WHERE id IS NOT NULL AND text IS NOT NULL),
k AS (SELECT id, array_to_string(w, ' ') AS k, w FROM e WHERE len(w) >= {neardup.MIN_WORDS}),
c AS (SELECT k, any_value(w) AS w FROM k GROUP BY k),
g AS (SELECT DISTINCT k, w[i:i + 2] AS g FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM c)),
n AS (SELECT k, count(*) AS n FROM g GROUP BY k),
b AS (SELECT x.k AS a, y.k AS b, count(*) AS shared FROM g x JOIN g y ON x.g = y.g AND x.k < y.k GROUP BY x.k, y.k),
l AS (SELECT a, b FROM b JOIN n x ON x.k = a JOIN n y ON y.k = b WHERE shared >= {neardup.SIMILARITY} * (x.n + y.n - shared) UNION ALL SELECT k, k FROM c),
h AS (SELECT h, [('0x' || substring(h, 16 * i + 1, 16))::UBIGINT FOR i IN range(4)] AS p FROM (SELECT DISTINCT lower(image_hash) AS h FROM image_assets) WHERE regexp_full_match(h, '[0-9a-f]{{64}}'))
SELECT DISTINCT 'element' AS record_kind, least(x.id, y.id) AS left_key, greatest(x.id, y.id) AS right_key FROM l JOIN k x ON x.k = l.a JOIN k y ON y.k = l.b WHERE x.id <> y.id
UNION ALL SELECT 'image', x.h, y.h FROM h x JOIN h y ON x.h < y.h WHERE bit_count(xor(x.p[1], y.p[1]))::INT + bit_count(xor(x.p[2], y.p[2]))::INT + bit_count(xor(x.p[3], y.p[3]))::INT + bit_count(xor(x.p[4], y.p[4]))::INT <= {neardup.RADIUS}"""


def oracle_sql() -> dict[str, str]:
    return {
        "p5_found": PAIRS,
        "p10_ratios": RATIOS,
        "p1_ends": ENDS,
        "p9_found": f"{LEAKS} SELECT * FROM leak",
        "p9_items": f"{LEAKS} SELECT item_id, suite, coalesce(n, 0) AS n_documents FROM eval_items LEFT JOIN (SELECT item_id, count(*) AS n FROM leak GROUP BY item_id) USING (item_id)",
        "p6_sizes": f"""WITH one AS ({ONE_ROW}),
placed AS (SELECT *, last_value(CASE WHEN heading THEN id END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY pos, id ROWS UNBOUNDED PRECEDING) AS section_id FROM one WHERE pos IS NOT NULL)
SELECT 'element' AS item_kind, id AS item_id, CAST(size AS BIGINT) AS size, true AS sound FROM one WHERE size > {pieces.ELEMENT_LIMIT}
UNION ALL SELECT 'section', section_id, CAST(sum(size) + count(*) FILTER (WHERE size > 0) AS BIGINT), true FROM placed WHERE section_id IS NOT NULL GROUP BY section_id HAVING sum(size) > {pieces.SECTION_LIMIT}""",
        "p6_found": f"""WITH one AS ({ONE_ROW}),
placed AS (SELECT *, last_value(CASE WHEN heading THEN id END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY pos, id ROWS UNBOUNDED PRECEDING) AS section_id FROM one WHERE pos IS NOT NULL)
SELECT 'element' AS item_kind, id AS item_id FROM one WHERE size > {pieces.ELEMENT_LIMIT}
UNION ALL SELECT 'section', section_id FROM placed WHERE section_id IS NOT NULL GROUP BY section_id HAVING sum(size) > {pieces.SECTION_LIMIT}""",
    }
