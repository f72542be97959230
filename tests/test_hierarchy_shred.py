import random

import pytest
from pyspark.sql import functions as F

from docstrata.operators import hierarchy, shred
from docstrata.runtime import table

ROW = "id string, document_id string, parent_id string, reading_order int, loaded_at timestamp, root string, state string"


def truth(rows):
    parent = {r[0]: r[2] for r in rows}
    states, paths = set(), {}
    for k in parent:
        path, v = [], k
        while True:
            if v in path:
                states.add((k, "cycle" if k in path[path.index(v) :] else "below_cycle"))
                break
            path.append(v)
            p = parent[v]
            if not p or p not in parent:
                if p and v == k:
                    states.add((k, "dangling"))
                paths[k] = path[::-1]
                break
            v = p
    return states, paths


@pytest.mark.parametrize("block", [1, 5, 4096])
def test_random_forests(spark, block):
    rng, rows = random.Random(block), []
    for doc in range(4):
        for i in range(40):
            p = rng.choice([None, "", "zz/z", *[f"{doc}/{rng.randrange(40)}" for _ in range(10)]])
            if rng.random() < 0.6 and i:
                p = f"{doc}/{rng.randrange(i)}"
            rows.append((f"{doc}/{i}", f"d{doc}", p, rng.choice([i, i, i, None]), None, "x", "y"))
    states, paths = truth(rows)
    df = spark.createDataFrame(rows + rows[:7], ROW)
    assert {tuple(r) for r in hierarchy.link_states(df, block).collect()} == states
    tree = hierarchy.trees(df, block, counts=True).collect()
    assert {r.element_id: r.path for r in tree if r.path is not None} == paths
    assert all(r.depth == len(r.path) - 1 and r.root_id == r.path[0] for r in tree if r.path is not None)
    below = {k: sum(k in p[:-1] for p in paths.values()) for k in paths}
    assert {r.element_id: r.n_descendants for r in tree if r.path is not None} == below


def test_long_chain_over_blocks(spark):
    rows = [(str(i), "d", str(i - 1) if i else None, i, None, "", "") for i in range(300)]
    tree = {r.element_id: r.depth for r in hierarchy.trees(spark.createDataFrame(rows, ROW), 7).collect()}
    assert tree == {str(i): i for i in range(300)}
    ring = [(str(i), "d", str((i + 1) % 300), i, None, "", "") for i in range(300)]
    assert {r.link_state for r in hierarchy.link_states(spark.createDataFrame(ring, ROW), 7).collect()} == {"cycle"}


def test_dirty_links(spark):
    rows = [(None, "d", "a", 0, None, "", ""), ("a", None, "a", None, None, "", ""), ("b", "d", "a", 1, None, "", ""), ("c", "d", None, 1, None, "", "")]
    got = {tuple(r) for r in hierarchy.link_states(spark.createDataFrame(rows, ROW)).collect()}
    assert got == {("a", "cycle"), ("b", "dangling")}
    assert hierarchy.link_states(spark.createDataFrame([], ROW)).isEmpty()


DOC = "id string, delivered_at timestamp, elements array<struct<id:string,provenance:array<struct<page:int>>>>, node string, key string"
TAB = "id string, delivered_at timestamp, cells array<struct<text:string,row:int,column:int,row_span:int,column_span:int,is_header:boolean>>, parent string"


def test_found_members(spark):
    docs = spark.sql("SELECT 'd' AS id, TIMESTAMP '2020-01-01' AS delivered_at, array(named_struct('id', 'old', 'provenance', array(named_struct('page', 1)))) AS elements, 'x' AS node, 'y' AS key")
    new = spark.sql("SELECT 'd', TIMESTAMP '2021-01-01', array(NULL, named_struct('id', 'e.1', 'provenance', array(NULL, named_struct('page', 1)))), 'x', 'y'")
    rest = spark.createDataFrame([("n", None, None, "", ""), ("z", None, [], "", ""), (None, None, [("q", None)], "", "")], DOC)
    tabs = spark.createDataFrame([("t", None, [None, ("", None, None, None, None, None)], "p"), ("t", None, [None, ("", None, None, None, None, None)], "p"), ("u", None, None, "p")], TAB)
    got = {tuple(r) for r in shred.found_members(docs.unionAll(new).unionAll(rest), tabs).collect()}
    assert got == {("element", "d", 1), ("provenance", "e.1", 1), ("cell", "t", 1)}
    assert shred.found_members(spark.createDataFrame([], DOC), spark.createDataFrame([], TAB)).isEmpty()


def test_round_trip_of_entities(spark, sf):
    tabs = shred.latest(table(spark, sf, "extracted_tables"), "id", "delivered_at")
    flat = shred.entities(shred.shred(tabs, "id", "table"), "cells", ["text", "row"])
    direct = tabs.select("id", F.posexplode("cells").alias("n", "c")).where("c IS NOT NULL").select("id", "n", "c.text", F.col("c.row").cast("string"))
    assert {tuple(r) for r in flat.select("parent", "ordinal", "text", "row").collect()} == {tuple(r) for r in direct.collect()}
