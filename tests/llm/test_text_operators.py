"""Small cases, dirty input and brute force for the text operators."""

import os
import random
import re
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from docstrata.llm import leaks, neardup, pieces, quality, queries, residue, scans, tokenize, truncation, vec
from docstrata.llm.components import components
from docstrata.runtime import table
from tests.conftest import DATA
from tests.oracle import same

IMAGE = "id string, document_id string, caption_source string, caption string, ocr_text string, image_hash string, loaded_at timestamp, residue string, text string, h string, n string"
ELEMENT = "id string, document_id string, type string, text string, reading_order int, heading_level int, loaded_at timestamp, provenance array<struct<page:int,source:string>>, h string, block string, section_id string, size string"
DOC = "doc_id bigint, text string, ids string, item_id string, n_words string"


def image(i, caption, source="s", ocr=None, h=None):
    return (i, "d", source, caption, ocr, h, None, "x", "x", "x", "x")


def element(i, text, kind="paragraph", order=0, level=None, doc="d", source="ocr"):
    return (i, doc, kind, text, order, level, None, [(1, source)] if source else None, "x", "x", "x", "x")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, sf, name):
    same(spark, sf, queries.queries()[name], queries.oracle_sql()[name])


@pytest.mark.parametrize("name", queries.NAMES)
def test_empty_and_null_tables(spark, sf, name, tmp_path):
    for t in ("image_assets", "canonical_elements", "documents", "eval_items", "common_words"):
        df = table(spark, sf, t)
        df.limit(0).write.parquet(str(tmp_path / "none" / f"{t}.parquet"))
        df.limit(3).selectExpr(*[f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in df.schema]).write.parquet(str(tmp_path / "null" / f"{t}.parquet"))
    assert queries.queries()[name](spark, str(tmp_path / "none")).isEmpty()
    queries.queries()[name](spark, str(tmp_path / "null")).collect()


# ---- problem 1


def test_truncation(spark):
    rng = random.Random(1)
    nouns = "pump valve motor tank filter switch panel relay boiler turbine".split()
    rows = []
    for i in range(400):
        a, b, c = (rng.choice(nouns) for _ in range(3))
        rows.append(image(f"whole{i}", f"Photograph of a {a} beside the {b}. The operator opens the {c} before the {a} starts."))
        rows.append(image(f"label{i % 40}", f"Site plan, {a} area"))
    cut = ["Photograph of a pump beside the valve. The operator opens the", "Photograph of a pump beside the val", "Photograph of a relay beside the tank. The operator op", "Photograph of a pump beside the valve. The <b", "Photograph of a pump besid&qu"]
    rows += [image(f"cut{i}", c) for i, c in enumerate(cut)] + [image("cut0", cut[0])]
    rows += [image("null", None), image("empty", ""), image("blank", "  "), image(None, cut[0]), image("residue", "Access denied. Reference #12")]
    df = spark.createDataFrame(rows, IMAGE)
    assert {r.image_id for r in truncation.found(df, residue.found(df)).collect()} == {f"cut{i}" for i in range(len(cut))}
    report = truncation.report(df, residue.found(df)).collect()
    assert [r.n_cut for r in report] == [len(cut)]


def test_truncation_of_frequent_labels(spark):
    rng = random.Random(2)
    nouns = "pump valve motor tank filter switch panel relay boiler turbine".split()
    rows = []
    for i in range(400):
        a, b, c, d = (rng.choice(nouns) for _ in range(4))
        rows.append(image(f"whole{i}", f"Photograph of the {a}, {b} and the {c}. The operator opens the {d} of the {a} before the start."))
        rows.append(image(f"parts{i}", f"Parts list for the {a}: {b}, {c} and {d}"))
        rows.append(image(f"plate{i}", f"Nameplate of the {a}"))
    cut = ["Parts list for the pump: panel, channel and the", "Parts list for the", "Nameplate of the"]
    rows += [image(f"cut{i}", c) for i, c in enumerate(cut)] + [image("cut0", cut[0])]
    df = spark.createDataFrame(rows, IMAGE)
    assert {r.image_id for r in truncation.found(df, residue.found(df)).collect()} == {f"cut{i}" for i in range(len(cut))}


def test_the_trigrams_decide(spark):
    data = f"{DATA}/sf0.01"
    if not os.path.isdir(data):
        pytest.skip("no test data")
    cut = truncation.decisions(table(spark, data, "image_assets")).where("cut")
    assert cut.where(f"end_share <= {truncation.SHARE}").count() >= 0.9 * cut.count() > 0


def test_no_blank_is_lost_where_the_end_begins(spark):
    texts = ["x" * 10 + " " + "word " * n + "end" for n in range(12)]
    texts_view = truncation._sql(spark, truncation.TEXTS, captions=spark.createDataFrame([image(str(i), t) for i, t in enumerate(texts)], IMAGE), trace=truncation.TRACE)
    assert {r.id: r.text for r in texts_view.collect()} == {str(i): t for i, t in enumerate(texts)}


# ---- problem 2


@pytest.mark.parametrize(
    "text",
    ["{{ caption }}", "Wiring plan for the <alt> pump.", "Figure 3: [INSERT title HERE]", "&lt;page&gt;", "%%tag%%", "#summary#", "__alt__ of the pump", "None", "tbd", "xxx xxx", "Lorem ipsum dolor sit amet magna.", "404 Not Found", "Access denied. Reference #1.2",
     "A pump beside a tank. Please enable JavaScript to zoom.", "Bitte aktivieren Sie JavaScript, um das Bild zu sehen.", "Veuillez activer JavaScript pour voir l'image.", "We use cookies. Accept all to show this figure.", '{"error": {"code": 500}}', "Seite nicht gefunden - Fehler 404", "ACCESS DENIED. REFERENCE #5"],
)
def test_residue(text):
    assert residue.is_residue(text)


@pytest.mark.parametrize(
    "text",
    [None, "", "  ", "Screenshot of the panel with the text “Error 5: pump not found” in the list.", "Sample label reading “INSERT pump HERE”, fixed to the tank.", "Loading curve of the pump; please note the valve on the right.", "Set of modes {A, B, C} drawn as nodes.",
     "Listing in which the variable $pump is set to 3.", "Placeholder plate used while the pump is under repair.", "Dialog asking the operator to enable the pump script before the tank starts.", "Access door with a sign that denies entry to the pump area.", "<p>Photograph of a pump.</p>", "Site plan, pump area"],
)
def test_no_residue(text):
    assert not residue.is_residue(text)


LONG = "pump beside the tank in the boiler room of the old plant, with the name of its photographer and the year"


@pytest.mark.parametrize("mark", ["{{ %s }}", "{%% %s %%}", "${%s}", "<%%= %s %%>", "[[%s]]", "[insert a short view of the %s]", "[The %s goes here]", "[add %s]"])
def test_long_placeholders(mark):
    assert residue.is_residue(f"Side view of the turbine hall. {mark % LONG} Valves are closed.")
    assert not residue.is_residue(f"Side view of the turbine hall. {LONG} Valves are closed.")


def test_placeholders_without_an_end_take_linear_time():
    start = time.monotonic()
    for mark in ("{{ ", "{% ", "${", "<%= ", "[[", "[insert ", "[ goes here "):
        for text in (mark * 20_000, mark + " " * 60_000, mark + "goes here " * 6_000):
            residue.is_residue("View of a pump. " + text)
    assert time.monotonic() - start < 30


# ---- problem 3


def small_model():
    text = "the relay drains the valve before the pump starts and the self-priming boiler cools the strainer whenever the drawing is read"
    words = {w: 50 for w in re.findall(r"[a-z]+(?:-[a-z]+)*", text)}
    return scans.Model(words, {}, frozenset({"harbor manual"}))


def kinds(text):
    return scans.repair(text, small_model())


def test_scan_repair():
    assert kinds("the re-\nlay drains\nthe valve") == ("the relay drains the valve", {"broken_word"})
    assert kinds("the self-\npriming boiler cools") == ("the self-priming boiler cools", set())
    assert kinds("the pu\u00ac\n\nHARBOR MANUAL 4\n\nmp starts\nthe valve") == ("the pump starts the valve", {"broken_word", "page_furniture"})
    assert kinds("the va1ve drams the purnp") == ("the valve drains the pump", {"misread"}) or kinds("the va1ve and the purnp") == ("the valve and the pump", {"misread"})
    assert kinds("the valve\n- 12 -\nand the pump")[1] == {"page_furniture"}
    assert kinds("TK-12 PV-9") == ("TK-12 PV-9", set())
    assert kinds("7b66" * 2000)[1] == set()
    assert kinds("Page 3")[1] == set()


def test_misread_words_that_look_like_tags_or_numbers():
    words = {w: 50 for w in "the control plate valve open seal load is ist drains before pump".split()}
    model = scans.Model(words, {}, frozenset())
    for seen, true in ("C0ntrol", "Control"), ("P1ate", "Plate"), ("V4lve", "Valve"), ("0pen", "open"), ("5eal", "seal"), ("1oad", "load"), ("C0ntr0l", "Control"):
        assert scans.repair(f"the {seen} drains the pump", model) == (f"the {true} drains the pump", {"misread"})
    assert scans.repair("the C0n-\ntrol drains", model) == ("the Control drains", {"broken_word", "misread"})
    for tag in "TK-131 PV9 XV341 I5 1st 5s 12mm 3D DN80 H2O 4th 0.5".split():
        assert scans.repair(f"the {tag} drains the pump", model) == (f"the {tag} drains the pump", set())


def test_all_candidates_reach_the_decoder():
    near = ["seal", "beal", "geal", "oeal", "aeal", "eeal", "ueal", "veal", "yeal"]
    words = {w: 1000 for w in [*near, "the"]} | {"zeal": 3}
    costs = {("5", w[0]): -3.0 - (w == "zeal") for w in [*near, "zeal"]} | {("rn", "m"): -1.0, ("6", "d"): -1.0}
    model = scans.Model(words, {("the", "zeal"): 990}, frozenset(), costs)
    assert len(model.candidates("5eal")) == 10 and model.decode(["the", "5eal"]) == ["the", "zeal"]
    model = scans.Model({"the": 1000, "dam": 1000, "darn": 50}, {("the", "dam"): 900}, frozenset(), costs)
    assert model.decode(["the", "6arn"]) == ["the", "dam"]


def test_scans_on_tables(spark):
    clean = [element(f"c{i}", "The pump drains the valve before the boiler starts.", source="layout") for i in range(9)]
    dirty = [element("a", "The pump dralns the valve before\nPage 3\nthe boi-\nler starts."), element("b", "The purnp", "heading"), element("n", None), element(None, "The purnp"), element("w", "The pump", source=None)]
    images = spark.createDataFrame([image("i", None, ocr="the boi-\nler starts"), image("j", None, ocr=" ")], IMAGE)
    df = spark.createDataFrame(clean + dirty + dirty[:1], ELEMENT)
    got = {tuple(r) for r in scans.found(df, images).collect()}
    assert got == {("element", "a", "misread"), ("element", "a", "page_furniture"), ("element", "a", "broken_word"), ("image", "i", "broken_word")}


def test_scans_against_gold(spark):
    data = f"{DATA}/sf0.01"
    if not os.path.isdir(data):
        pytest.skip("no test data")
    fixed = {r.record_id: r.text for r in scans.repaired(table(spark, data, "canonical_elements"), table(spark, data, "image_assets")).where("record_kind = 'element'").collect()}
    gold = [s for r in table(spark, data, "gold_samples").collect() for s in r.samples or [] if s and len(s.reading_order_element_ids or []) == 1]
    pairs = [(fixed[s.reading_order_element_ids[0]], s.expected_text) for s in gold if s.reading_order_element_ids[0] in fixed]
    right = sum(a == " ".join(b.split()) for a, b in pairs)
    assert len(pairs) >= 20 and right >= 0.98 * len(pairs)


def test_the_size_of_the_corpus_changes_nothing(spark):
    clean = [element(f"c{i}", "The pump drains the valve before the boiler starts.", source="layout") for i in range(3)]
    dirty = [element("a", "The pump dralns the valve before\nthe boi-\nler starts."), element("b", "The boi1er and the va1ve")]
    rng = random.Random(6)
    other = [element(f"o{i}", " ".join("".join(rng.choice("kxz") for _ in range(7)) for _ in range(30)), "paragraph", source="layout") for i in range(3000)]
    none = spark.createDataFrame([], IMAGE)
    alone = {r.record_id: r.text for r in scans.repaired(spark.createDataFrame(clean + dirty, ELEMENT), none).collect()}
    beside = {r.record_id: r.text for r in scans.repaired(spark.createDataFrame(clean + dirty + other, ELEMENT), none).collect()}
    assert alone["a"] == "The pump drains the valve before the boiler starts." and alone["b"] == "The boiler and the valve"
    assert all(beside[k] == v for k, v in alone.items())


def test_counts_by_hash_equal_those_of_spark(spark):
    rows = [("word", w, "", n) for n, w in enumerate(["pump", "ventil", "größe", "汉字"], 5)] + [("pair", "pump", "größe", 9), ("head", "manual #", "", 1), ("word", "rare", "", 2)]
    name, total, longest = scans.write_model(spark.createDataFrame(rows, "kind string, a string, b string, n bigint"), "word")
    words, pairs, heads = scans.read_model(name)
    assert [words.get(w) for w in ("pump", "ventil", "größe", "汉字", "rare", "")] == [5, 6, 7, 8, 0, 0] and (total, longest) == (26, 6)
    assert pairs.get(("pump", "größe")) == 9 and ("größe", "pump") not in pairs and "manual #" in heads and words.any_of(["x", "pump", "rare"]) == [1]


def test_no_length_keeps_a_word_from_being_read():
    model = scans.Model({"window": 50}, {}, frozenset())
    assert [w for w, _ in model.candidates("\\/\\/indo\\/\\/")] == ["window"]


def test_confusions_are_learned_from_words_in_one_place(spark):
    words = ["pumping", "damping", "mapping", "stopping", "coupling", "tapping"]
    rows = [("word", w, "", 100) for w in words] + [("scan", w.replace("p", "þ", 1), "", 2) for w in words]
    assert scans.learned_confusions(spark.createDataFrame(rows, "kind string, a string, b string, n bigint")) == [("þ", "p")]


# ---- problem 5


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    sizes, sets = [], []
    for k in range(40):
        base = rng.integers(0, 2**63, 100).astype(np.uint64)
        other = base.copy()
        other[: k * 2] = rng.integers(0, 2**63, k * 2).astype(np.uint64)
        sets += [np.unique(base), np.unique(other)]
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    sig = neardup.superminhash(np.concatenate(sets), doc, len(sets))
    for a in range(0, len(sets), 2):
        both = len(np.intersect1d(sets[a], sets[a + 1]))
        true = both / (len(sets[a]) + len(sets[a + 1]) - both)
        assert abs((sig[a] == sig[a + 1]).mean() - true) < 0.2
    sizes.append(sig.shape)
    assert sizes == [(80, neardup.POSITIONS)] and (sig < np.uint64(neardup.POSITIONS) << np.uint64(32)).all()


def brute_pairs(rows):
    by, sets = defaultdict(set), {}
    for i, t in rows:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        if i is not None and len(w) >= 40:
            by[" ".join(w)].add(i)
            sets[" ".join(w)] = set(zip(w, w[1:], w[2:]))
    keys, out = sorted(by), set()
    for a, x in enumerate(keys):
        for y in keys[a:]:
            if len(sets[x] & sets[y]) >= 0.5 * len(sets[x] | sets[y]):
                out |= {(min(i, j), max(i, j)) for i in by[x] for j in by[y] if i != j}
    return out


def test_near_duplicate_texts(spark, sf):
    df = table(spark, sf, "canonical_elements")
    expected = brute_pairs([(r.id, r.text) for r in df.select("id", "text").collect()])
    got = neardup.found(df, table(spark, sf, "image_assets")).where("record_kind = 'element'")
    assert {(r.left_key, r.right_key) for r in got.collect()} == expected


def test_copies_and_long_texts(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    text = " ".join(rng.choice(words) for _ in range(60))
    long = " ".join(rng.choice(words) for _ in range(20000))
    rows = [element(f"e{i:03d}", text) for i in range(neardup.EXPAND + 6)] + [element("z", text + " tail"), element("L1", long), element("L2", long + " end"), element("short", "a b"), element("n", None), element(None, text)]
    pairs = {(r.left_key, r.right_key) for r in neardup.found(spark.createDataFrame(rows, ELEMENT), spark.createDataFrame([], IMAGE)).collect()}
    assert pairs == {("e000", f"e{i:03d}") for i in range(1, neardup.EXPAND + 6)} | {("e000", "z"), ("L1", "L2")}
    classes = {r.record_key: r.class_key for r in neardup.groups(spark.createDataFrame(rows, ELEMENT), spark.createDataFrame([], IMAGE)).collect()}
    assert {classes[f"e{i:03d}"] for i in range(neardup.EXPAND + 6)} == {"e000"} and classes["z"] == "e000" and classes["short"] == "short" and classes["L2"] == "L1"


def test_many_texts_of_equal_words(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(3000)}" for _ in range(60)]
    texts = [" ".join(words[:k] + [words[k] + ","] + words[k + 1 :]) for k in range(40)]
    rows = [(f"v{i:02d}", t) for i, t in enumerate(texts + [t.upper() for t in texts])] + [("z", texts[0] + " tail"), ("v03", texts[1])]
    df, none = spark.createDataFrame([element(i, t) for i, t in rows], ELEMENT), spark.createDataFrame([], IMAGE)
    expected = brute_pairs(rows)
    assert len(expected) == 81 * 80 // 2
    assert {(r.left_key, r.right_key) for r in neardup.found(df, none).collect()} == expected
    assert {r.record_key: r.n_links for r in neardup.groups(df, none).collect()} == {i: 80 for i, _ in rows}


def test_copies_and_their_links_are_counted(spark):
    text = " ".join(f"w{k}" for k in range(60))
    size = neardup.EXPAND + 6
    rows = [element(f"e{i:03d}", text) for i in range(size)] + [element("z", text + " tail"), element("z2", text + " tail"), element("short", "a b")]
    df, none = spark.createDataFrame(rows, ELEMENT), spark.createDataFrame([], IMAGE)
    links = {r.record_key: r.n_links for r in neardup.groups(df, none).collect()}
    assert links == {f"e{i:03d}": size + 1 for i in range(size)} | {"z": size + 1, "z2": size + 1, "short": 0}
    held = {r.element_id: (r.copy_key, r.n_copies) for r in neardup.copies(df).collect()}
    assert held == {f"e{i:03d}": ("e000", size) for i in range(size)} | {"z": ("z", 2), "z2": ("z", 2)}
    by = defaultdict(set)
    for i, (k, _) in held.items():
        by[k].add(i)
    pairs = {(r.left_key, r.right_key) for r in neardup.found(df, none).collect()}
    full = {(min(i, j), max(i, j)) for a, b in pairs | {(k, k) for k in by} for i in by[held[a][0]] for j in by[held[b][0]] if i != j}
    assert full == brute_pairs([(r[0], r[3]) for r in rows])


def test_hashes_within_the_radius_are_never_missed(spark):
    rng, rows, values = random.Random(3), [], []
    for k in range(60):
        base = rng.getrandbits(256)
        near = base
        for b in rng.sample(range(256), k % 25):
            near ^= 1 << b
        values += [base, near]
    worst = rng.getrandbits(256)
    spread = worst
    for block in range(24):  # one bit in each of 24 blocks of 8
        spread ^= 1 << (8 * block)
    values += [worst, spread, worst]
    rows = [image(str(i), None, h=f"{v:064x}".upper() if i % 2 else f"{v:064x}") for i, v in enumerate(values)]
    rows += [image("bad", None, h="xyz"), image("none", None), image("empty", None, h="")]
    got = {(r.left_key, r.right_key) for r in neardup.hash_links(spark.createDataFrame(rows, IMAGE)).collect()}
    distinct = sorted({f"{v:064x}" for v in values})
    assert got == {(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if (int(a, 16) ^ int(b, 16)).bit_count() <= 24}


def test_hot_buckets_are_compared_block_by_block(spark):
    """1,200 variants of one template meet in the same buckets; so do hashes with equal blocks."""
    rng = random.Random(7)
    words = [f"w{rng.randrange(3000)}" for _ in range(300)]
    rows = [element(f"v{i:04d}", " ".join([*words, f"n{i}"])) for i in range(1200)]
    none = spark.createDataFrame([], IMAGE)
    members, links = neardup.text_links(spark.createDataFrame(rows, ELEMENT), bucket_rows=100)
    assert links.distinct().count() == 1200 * 1199 // 2 and members.count() == 1200
    values = [(rng.getrandbits(64) << 192) | (rng.getrandbits(20) << 10) for _ in range(3000)]
    images = spark.createDataFrame([image(str(i), None, h=f"{v:064x}") for i, v in enumerate(values)], IMAGE)
    assert {tuple(r) for r in neardup.hash_links(images, bucket_rows=50).collect()} == {tuple(r) for r in neardup.hash_links(images).collect()} != set()
    assert neardup.groups(spark.createDataFrame(rows[:300], ELEMENT), none).select("class_key").distinct().count() == 1


@pytest.mark.parametrize("width", [2, 3])
def test_many_hashes(spark, width):
    rng, values, near = random.Random(8), [], 0
    for k in range(20_000 if width == 2 else 3000):
        base = other = rng.getrandbits(256)
        for b in rng.sample(range(256), k % 40):
            other ^= 1 << b
        near += 0 < k % 40 <= neardup.RADIUS
        values += [base, other]
    df = spark.createDataFrame([image(str(i), None, h=f"{v:064x}") for i, v in enumerate(values)], IMAGE)
    assert neardup.hash_links(df, width=width).count() == near
    assert [neardup.blocks_per_key(n) for n in (10**4, 10**7, 10**10)] == [2, 3, 4]


def test_recall_just_over_the_threshold(spark):
    """Pairs with a similarity between 0.50 and 0.55, of which at most 2 % may be missed."""
    rng, rows = random.Random(9), []
    for k in range(400):
        words = [f"k{k}w{rng.randrange(10**6)}" for _ in range(120)]
        new = [f"k{k}v{rng.randrange(10**6)}" for _ in range(39 - k % 4)]
        rows += [element(f"a{k:03d}", " ".join(words)), element(f"b{k:03d}", " ".join(words[: len(words) - len(new)] + new))]
    expected = brute_pairs([(r[0], r[3]) for r in rows])
    got = {(r.left_key, r.right_key) for r in neardup.found(spark.createDataFrame(rows, ELEMENT), spark.createDataFrame([], IMAGE)).collect()}
    assert len(expected) == 400 and got <= expected and len(got) >= 0.98 * 400


def test_components(spark):
    pairs = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(100) if i % 20 != 19] + [("x", "x"), ("a", "b"), ("b", "a")]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a string, b string").repartition(4)).collect()}
    assert got == {f"n{i:03d}": f"n{i - i % 20:03d}" for i in range(100)} | {"a": "a", "b": "a"}


# ---- problem 6


def test_pieces_cover_the_text():
    rng = random.Random(4)
    for size in (0, 5, 1199, 1200, 1201, 5000, 60000):
        for made in ("word. ", "word ", "x", "one two three. ", "línea\n"):
            text = (made * (size // len(made) + 1))[:size]
            parts = pieces.cut(text, 1200)
            assert "".join(text[a:b] for _, a, b in parts) == text
            assert all(b - back <= 1200 and 0 <= a - back <= pieces.OVERLAP for back, a, b in parts)
    topics = " ".join(" ".join(f"{rng.choice(t)} {rng.choice(t)} {rng.choice(t)}." for _ in range(30)) for t in (["pump", "valve", "tank"], ["poem", "verse", "rhyme"]))
    first = pieces.cut(topics, len(topics) - 200)[0]
    assert "poem" not in topics[first[1] : first[2]] and "verse" not in topics[first[1] : first[2]]


def test_sections_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK_ROWS", 8)
    rows = [element("pre", "before any heading", order=0)]
    order = 1
    for h in range(3):
        rows.append(element(f"h{h}", "Heading", "heading", order, 1))
        for k in range(40):
            order += 1
            rows.append(element(f"h{h}_{k}", None if k == 5 else f"Sentence {k} of section {h}. " * (8 if h else 1), order=order))
        order += 1
    rows.append(element("big", "Long text. " * 200, order=None))
    df = spark.createDataFrame(rows + rows[:20], ELEMENT)
    monkeypatch.setattr(pieces.sections, "__defaults__", (8,))
    assert {tuple(r) for r in pieces.found(df).collect()} == {("section", "h1"), ("section", "h2"), ("element", "big")}
    out = pieces.pieces(df).where("item_id = 'h1'").orderBy("piece").collect()
    whole = "".join(r.text[r.overlap :] for r in out)
    assert whole == "Heading\n" + "".join(f"{f'Sentence {k} of section 1. ' * 8}\n" for k in range(40) if k != 5)
    assert [r.piece for r in out] == list(range(out[0].n_pieces)) and all(len(r.text) <= pieces.SECTION_LIMIT for r in out)


# ---- problem 8


@pytest.fixture(scope="module")
def ranks():
    path = os.path.join(tokenize.TOKENIZER_DIR, tokenize.VOCABULARY)
    if not os.path.exists(path):
        pytest.skip("no vocabulary")
    return tokenize.load_ranks(path)


def test_encoding_equals_the_public_library(spark, sf, ranks):
    tiktoken = pytest.importorskip("tiktoken")
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    letters = "ab '\n\t  sdtmrevl12.,\x1c é漢½٣’  \r\n<|endoftext|>😀"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [None, "", "a" * 30000, " " * 5000, "'s's'll'x", "<|endoftext|>"]
    df = spark.createDataFrame([(i, t, "x", "x", "x") for i, t in enumerate(texts)], DOC)
    got = {r.doc_id: r.ids for r in tokenize.encode(df).collect()}
    assert got == {i: known.encode_ordinary(t or "") for i, t in enumerate(texts)}
    docs = table(spark, sf, "documents")
    assert {r.doc_id: r.ids for r in queries.p8_ids(spark, sf).collect()} == {r.doc_id: known.encode_ordinary(r.text or "") for r in docs.collect()}


def test_transducer(ranks, tmp_path):
    entries = [(w, [i, 7] if i % 3 else [i]) for w, i in sorted(ranks.items()) if len(w) <= tokenize.LEXICON_BYTES]
    arrays = tokenize.build_transducer(entries)
    tokenize.Lexicon.write(arrays, ranks, str(tmp_path / "x"))
    lex = tokenize.Lexicon(str(tmp_path / "x"))
    words = [w for w, _ in entries[::7]] + [b"qzqzqzqz", b"", b"x" * 500]
    size = np.array([len(w) for w in words])
    rank = lex.find(np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size)
    assert [lex.ids[lex.seq[r] : lex.seq[r + 1]].tolist() for r in rank[:-3]] == [ids for _, ids in entries[::7]] and (rank[-3:] == -1).all()
    assert lex.ranks == ranks
    assert len(arrays["final"]) < sum(len(w) for w, _ in entries) / 3


@pytest.mark.parametrize("words", [0, 1, 50])
def test_the_lexicon_changes_no_ids(spark, sf, ranks, words):
    docs = table(spark, sf, "documents")
    few = {r.doc_id: r.ids for r in tokenize.encode(docs, lexicon_words=words).collect()}
    assert few == {r.doc_id: r.ids for r in tokenize.encode(docs).collect()}


def test_most_words_are_served_by_the_automaton(spark, sf, ranks, tmp_path):
    docs = table(spark, sf, "documents")
    entries = tokenize.frequent_words(docs, tokenize.ship(spark, [], ranks), tokenize.LEXICON_WORDS)
    tokenize.Lexicon.write(tokenize.build_transducer(entries), ranks, str(tmp_path / "x"))
    lex = tokenize.Lexicon(str(tmp_path / "x"))
    asked = []
    lex.merged = lambda w: asked.append(w) or [0]
    ids, n = tokenize.encode_batch(pa.array([r.text for r in docs.collect()]), lex)
    assert len(asked) < 0.05 * n.sum()


# ---- problem 9


def brute_leaks(docs, items):
    words = lambda t: re.findall(r"[^\W_]+", re.sub(r"\\[A-Za-z]+", " ", t or "").lower())
    grams = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(len(w) - 12):
            grams[tuple(w[k : k + 13])].add(i)
    return {(d, i) for d, t in docs for w in [words(t)] for k in range(len(w) - 12) for i in grams.get(tuple(w[k : k + 13]), ())}


@pytest.mark.parametrize("block", [leaks.BLOCK_WORDS, 20])
def test_leaks_against_brute_force(spark, block):
    rng = random.Random(6)
    vocabulary = [f"word{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 40)))) for i in range(30)] + [(98, None), (99, "")]
    docs = []
    for d in range(150):
        w = [rng.choice(vocabulary) for _ in range(60)]
        part = items[rng.randrange(30)][1].split()
        n = rng.choice([11, 12, 13, 14, 40])
        at = rng.randrange(50)
        w[at:at] = part[:n]
        docs.append((d, rng.choice([" ", "  ", ", ", " \\emph{", "\n% "]).join(w)))
    docs += [(1000, None), (1001, ""), (1002, "\\alpha " * 50)]
    df = spark.createDataFrame([(d, t, "x", "x", "x") for d, t in docs], DOC)
    got = {tuple(r) for r in leaks.leaks(df, spark.createDataFrame(items, "item_id bigint, text string"), block).collect()}
    assert got == brute_leaks(docs, items)


# ---- problem 10


@pytest.mark.parametrize(
    "text, kind",
    [
        ("a | b | c\n1 | 2 | 3\n4 | 5 | 6\n7 | 8 | 9", "table"), ("x,1.5,2.5\ny,2.5,3.5\nz,1.0,2.0\nw,1,2", "table"), ("cache      1.5    2.0\nqueue      2.5    3.0\nprior      0.5    9.0", "table"),
        ("- pump\n- valve\n* tank\n- motor", "list"), ("\\begin{itemize}\n\\item red pump\n\\item blue valve\n\\item tank\n\\end{itemize}", "list"), ("cache, 1, 7\nqueue, 2, 9\nprior, 3, 4", "list"), ("1) pump of tank\n2) valve of tank\n3) motor of pump", "list"),
        ("qq\n" * 50, "junk"), ("\\relax " * 60, "junk"), ("\\input{a}\n\\input{b}\n\\input{c}", "junk"), ("aGVsbG8gd29ybGQhIGJhc2U2NA" * 30, "junk"), ("Overfull \\hbox (3pt too wide)\n! Undefined control sequence.\nl.12 \\foo\n" * 9, "junk"), ("|@#~^%" * 80, "junk"),
        ("The pump is in the house and the valve of it was not on the wall.\n" * 3, None),
    ],
)
def test_text_classes(text, kind):
    common = frozenset("the is in and of it was not on a to".split())
    assert quality.analyse(text, common)["text_class"] == kind


PARTS = [
    "Copper flange DN80 upstream condenser bracket assembly spare gasket ring", "Steel elbow DN25 downstream boiler vessel manifold drain plug sealing tape", "Bronze impeller series seven centrifugal pump housing stage two bearing sleeve",
    "Rubber diaphragm metering pump head suction side clamp bolt washer pair", "Brass nozzle spray header cooling tower basin level float arm hinge", "Glass gauge column high pressure drum isolation cock handle left hand thread",
]
POOL = " ".join(PARTS).split()


@pytest.mark.parametrize(
    "lines, kind",
    [
        ([" " + s for s in PARTS], "list"), (["  " * (i % 2) + s for i, s in enumerate(PARTS)], "list"), ([" ".join(POOL[(5 * k + j) % len(POOL)] for j in range(9 + k // 3)) for k in range(24)], "list"),
        ([" ".join(w[:6].ljust(6, "x") for w in s.split()[:9]) for s in PARTS], "table"), (PARTS, "junk"), ([" " + "aGVsbG8gd29ybGQhIGJhc2U2NA" * 3 + s[:4].strip() for s in PARTS], "junk"), (["  " + s.replace("e", ";").replace("a", "\\") for s in PARTS], "junk"),
    ],
)
def test_layout_of_lines_without_marks(lines, kind):
    common = frozenset("the is in and of it was not on a to".split())
    assert quality.analyse("\n".join(lines), common)["text_class"] == kind


def test_each_detector_of_layout_decides(monkeypatch):
    common = frozenset("the is in and of it was not on a to".split())
    table_text = "x,1.5,2.5\ny,25.5,3.5\nz,1.0,2.0\nwide,1,2"
    indented = "\n".join(" " + s for s in PARTS)
    waves = "\n".join(" ".join(POOL[(5 * k + j) % len(POOL)] for j in range(9 + k // 3)) for k in range(24))
    for name, plain, text in (("columns_of", lambda s: ("", 0), table_text), ("periodicity", lambda x: 0.0, indented), ("autocorrelation", lambda x, lags: 0.0, waves)):
        before = quality.analyse(text, common)["text_class"]
        with monkeypatch.context() as m:
            m.setattr(quality, name, plain)
            assert quality.analyse(text, common)["text_class"] != before


def test_statistics_rows(spark):
    df = spark.createDataFrame([(1, "The pump is in the house.", "", "", ""), (2, None, "", "", ""), (3, "", "", "", ""), (4, " \ufeff\n", "", "", ""), (4, " \ufeff\n", "", "", ""), (5, "a" * 300000, "", "", ""), (None, "x", "", "", "")], DOC)
    words = spark.createDataFrame([("en", "THE"), ("en", "is"), (None, None)], "lang string, word string")
    rows = {r.doc_id: r for r in quality.statistics(df, words).collect()}
    assert rows[1].n_words == 6 and rows[1].symbol_ratio == pytest.approx(1 / 25) and rows[1].end_punctuation_share == 1.0
    assert rows[2].n_words == rows[3].n_words == rows[4].n_words == 0 and rows[2].text_class is None and rows[5].text_class == "junk"


# ---- shared


def test_words_equal_the_pattern():
    texts = ["Ab_c d-1 ÄÖ ß’x \\emph{Foo}\\a1", None, "", "漢字 x²"]
    cp, starts = vec.codepoints(pa.array(texts))
    _, row, s, e = vec.words(cp, starts)
    got = [[] for _ in texts]
    for r, a, b in zip(row, s, e):
        got[r].append("".join(map(chr, cp[a:b])).lower())
    assert got == [re.findall(r"[^\W_]+", (t or "").lower()) for t in texts]
