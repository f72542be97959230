"""Parent links to full hierarchies (problem 7).

Weighted disjoint-set forests, in two layers:

1. The rows of a document are cut into blocks of consecutive reading order. Inside
   a block a weighted forest (root plus offset to it, with path compression) links
   children to parents. A block holds a bounded number of rows however large its
   document is, so no document becomes one task.
2. What leaves the blocks is one row per local root whose parent lies in another
   block. These contracted links are merged by pairs of forests: each round joins
   the roots with the roots they point at and adds the offsets, so that a chain of
   n blocks takes log2(n) rounds. A link still open when 2^rounds exceeds the number
   of contracted roots runs into a cycle.

Paths are then materialised from the indexed parents: the path inside the block,
prefixed with the path of the node that the block's root hangs from.

Defined results for dirty input: null or empty parent_id: a root; null id: no node;
rows with equal (document_id, id): one node, the latest by loaded_at, then the largest
parent_id, holds; a parent_id equal to its own id: a cycle of one; a null document_id
counts as the document ''; an empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.runtime import checkpoint

BLOCK_ROWS = 4096
LOCAL_SCHEMA = "document_id string, id string, root string, off bigint, exit string, local_path array<string>, state string, below bigint"
STATES = ("", "cycle", "below_cycle")


def nodes(elements: DataFrame) -> DataFrame:
    """(document_id, id, parent_id, pos): one row per element; parent_id null for roots."""
    loaded = F.col("loaded_at") if "loaded_at" in elements.columns else F.lit(None).cast("timestamp")
    order = F.struct(loaded.alias("at"), F.nullif(F.col("parent_id"), F.lit("")).alias("parent_id"), F.col("reading_order").alias("pos"))
    return (
        elements.where(F.col("id").isNotNull())
        .select(F.coalesce("document_id", F.lit("")).alias("document_id"), "id", order.alias("o"))
        .groupBy("document_id", "id")
        .agg(F.max("o").alias("o"))
        .select("document_id", "id", F.col("o.parent_id").alias("parent_id"), F.col("o.pos").alias("pos"))
    )


def weighted_forest(parents: list[int]) -> tuple[list[int], list[int], list[int]]:
    """parents[i] is the index of i's parent or -1. Returns root, offset to the root and a
    flag: 0 in a tree, 1 on a cycle, 2 below one."""
    n = len(parents)
    root, off, flag, walk = [-1] * n, [0] * n, [0] * n, [-1] * n
    for start in range(n):
        chain, v = [], start
        while v >= 0 and root[v] < 0 and walk[v] != start:
            walk[v] = start
            chain.append(v)
            v = parents[v]
        if v < 0:
            base, depth, kind = (chain[-1] if chain else -1), -1, 0
        elif root[v] < 0:  # the walk met itself
            at = chain.index(v)
            for k in chain[at:]:
                root[k], flag[k] = v, 1
            del chain[at:]
            base, depth, kind = v, 0, 2
        else:
            base, depth, kind = root[v], off[v], 2 if flag[v] else 0
        for k in reversed(chain):
            depth += 1
            root[k], off[k], flag[k] = base, depth, kind
    return root, off, flag


def _solve(rows: dict[str, list]) -> pa.RecordBatch:
    doc, block, ids, parent = rows["document_id"], rows["block"], rows["id"], rows["parent_id"]
    at = {key: i for i, key in enumerate(zip(doc, block, ids))}
    parents = [-1 if p is None else at.get((d, b, p), -1) for d, b, p in zip(doc, block, parent)]
    root, off, flag = weighted_forest(parents)
    paths: list = [None] * len(ids)
    for i in sorted(range(len(ids)), key=off.__getitem__):
        if not flag[i]:
            paths[i] = [ids[i]] if parents[i] < 0 else [*paths[parents[i]], ids[i]]
    below = [0] * len(ids)
    for i in sorted(range(len(ids)), key=off.__getitem__, reverse=True):
        if not flag[i] and parents[i] >= 0:
            below[parents[i]] += below[i] + 1
    out = {
        "document_id": doc, "id": ids, "root": [ids[r] for r in root], "off": off,
        "exit": [None if f else parent[r] for r, f in zip(root, flag)], "local_path": paths, "state": [STATES[f] for f in flag], "below": below,
    }
    types = {"off": pa.int64(), "below": pa.int64(), "local_path": pa.list_(pa.string())}
    return pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.string())) for k, v in out.items()], names=list(out))


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by document and block; a block cut by a batch's end is carried on."""
    held: dict[str, list] | None = None
    for batch in batches:
        rows = batch.to_pydict()
        if held:
            rows = {k: held[k] + rows[k] for k in rows}
        n = len(rows["id"])
        if not n:
            continue
        cut, last = n - 1, (rows["document_id"][-1], rows["block"][-1])
        while cut >= 0 and (rows["document_id"][cut], rows["block"][cut]) == last:
            cut -= 1
        if cut >= 0:
            yield _solve({k: v[: cut + 1] for k, v in rows.items()})
        held = {k: v[cut + 1 :] for k, v in rows.items()}
    if held and held["id"]:
        yield _solve(held)


def local_forests(n: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every node with its local root, the offset to it, and the parent which the local root
    has outside the block (exit). Rows without a usable position are salted over 64 blocks."""
    spread = F.pmod(F.xxhash64("id"), F.lit(64)).cast("int") * -1 - 1
    block = F.when(F.col("pos").isNull(), spread).otherwise(F.floor(F.col("pos") / block_rows).cast("int"))
    rows = n.select("document_id", block.alias("block"), "id", "parent_id")
    return rows.repartition("document_id", "block").sortWithinPartitions("document_id", "block").mapInArrow(_local, LOCAL_SCHEMA)


def contracted(local: DataFrame) -> DataFrame:
    """One row per local root with an exit: (document_id, root, to, top, dist, state).
    state null: the parent's local root has an exit itself."""
    links = local.where(F.col("exit").isNotNull() & (F.col("id") == F.col("root"))).select("document_id", "root", F.col("exit").alias("to"))
    target = local.select("document_id", F.col("id").alias("to"), F.col("root").alias("t_root"), F.col("off").alias("t_off"), F.col("state").alias("t_state"), F.col("exit").alias("t_exit"))
    lost = F.col("t_root").isNull()
    state = F.when(lost, "dangling").when(F.col("t_state") != "", "below_cycle").when(F.col("t_exit").isNull(), "")
    return links.join(target, ["document_id", "to"], "left").select(
        "document_id", "root", "to",
        F.when(lost, F.col("root")).otherwise(F.col("t_root")).alias("top"),
        F.when(lost, 0).otherwise(F.col("t_off") + 1).cast("bigint").alias("dist"),
        state.alias("state"),
    )


def resolve(links: DataFrame) -> DataFrame:
    """Merge the contracted forests: every round doubles the span of an open link. No chain of
    a document is longer than its number of contracted roots. Rows that are closed are written once."""
    current, rounds = links.select("document_id", "root", "top", "dist", "state"), 0
    is_open = F.col("state").isNull()
    span = current.where(is_open).groupBy("document_id").count().agg(F.max("count")).first()[0] or 0
    closed, open_ = [current.where(~is_open)], current.where(is_open)
    left = span
    while left and (1 << rounds) <= span:
        nxt = reduce(DataFrame.unionByName, [*closed, open_]).select("document_id", F.col("root").alias("top"), F.col("top").alias("n_top"), F.col("dist").alias("n_dist"), F.col("state").alias("n_state"))
        moved = checkpoint(open_.join(nxt, ["document_id", "top"]).select(
            "document_id", "root", F.col("n_top").alias("top"), (F.col("dist") + F.col("n_dist")).alias("dist"),
            F.when(F.col("n_state") == "dangling", "").otherwise(F.col("n_state")).alias("state"),
        ))
        closed.append(moved.where(~is_open))
        open_ = moved.where(is_open)
        rounds += 1
        left = open_.count()
    current = reduce(DataFrame.unionByName, [*closed, open_])
    if left:  # after that many steps the top of each lies on a cycle, and each of a cycle is a top
        on = open_.select("document_id", F.col("top").alias("root"), F.lit("cycle").alias("on")).distinct()
        current = current.join(on, ["document_id", "root"], "left").withColumn("state", F.coalesce("state", "on", F.lit("below_cycle"))).drop("on")
    return current


def prefixes(local: DataFrame, links: DataFrame, done: DataFrame) -> DataFrame:
    """(document_id, root, prefix): ids from the final root down to the node that each sound
    contracted root hangs from, put together by doubling as well."""
    sound = done.where(F.col("state") == "").select("document_id", "root")
    target = local.select("document_id", F.col("id").alias("to"), F.col("root").alias("next"), F.col("local_path").alias("prefix"))
    open_ = checkpoint(links.join(sound, ["document_id", "root"], "left_semi").join(target, ["document_id", "to"]).select("document_id", "root", "next", "prefix"))
    closed: list[DataFrame] = []
    while True:
        above = reduce(DataFrame.unionByName, [*closed, open_]).select("document_id", F.col("root").alias("next"), F.col("next").alias("n_next"), F.col("prefix").alias("n_prefix"))
        moved = checkpoint(open_.join(above, ["document_id", "next"], "left").select("document_id", "root", F.col("n_next").alias("next"), F.when(F.col("n_prefix").isNotNull(), F.concat("n_prefix", "prefix")).otherwise(F.col("prefix")).alias("prefix")))
        closed.append(moved.where(F.col("next").isNull()))
        open_ = moved.where(F.col("next").isNotNull())
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, closed).drop("next")


def solve(elements: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    local = checkpoint(local_forests(nodes(elements), block_rows))
    links = checkpoint(contracted(local))
    return local, links, resolve(links)


def _states(local: DataFrame, links: DataFrame, done: DataFrame) -> DataFrame:
    """(document_id, id, link_state) of broken nodes, distinct."""
    dangling = links.where(F.col("state") == "dangling").select("document_id", F.col("root").alias("id"), F.lit("dangling").alias("link_state"))
    inside = local.where(F.col("state") != "").select("document_id", "id", F.col("state").alias("link_state"))
    bad = done.where(F.col("state").isin("cycle", "below_cycle")).select("document_id", "root", F.col("state").alias("r_state"))
    members = local.select("document_id", "id", "root", "local_path").join(bad, ["document_id", "root"])
    # A cycle through several blocks passes, in each, from the node that the root of another
    # block on it hangs from, up to the local root.
    entries = links.join(bad.where(F.col("r_state") == "cycle").select("document_id", "root"), ["document_id", "root"], "left_semi").select("document_id", F.col("to").alias("id"))
    on = members.join(entries, ["document_id", "id"], "left_semi").select("document_id", F.explode("local_path").alias("id")).distinct().withColumn("on", F.lit("cycle"))
    across = members.join(on, ["document_id", "id"], "left").select("document_id", "id", F.coalesce("on", F.lit("below_cycle")).alias("link_state"))
    return dangling.unionByName(inside).unionByName(across).distinct()


def link_states(elements: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """element_id, link_state: 'cycle', 'below_cycle' or 'dangling'; sound links give no row."""
    return _states(*solve(elements, block_rows)).select(F.col("id").alias("element_id"), "link_state").distinct()


def trees(elements: DataFrame, block_rows: int = BLOCK_ROWS, counts: bool = False) -> DataFrame:
    """One row per element: document_id, element_id, root_id, depth, path (array of ids from
    the root), link_state (null if sound). A dangling element is the root of what is below
    it. On or below a cycle, root_id, depth and path are null. counts: also n_descendants.

    Descendants are counted from below: inside a block by the block's own forest; what hangs from
    another block is added once per local tree to each node above it, never once per node."""
    local, links, done = solve(elements, block_rows)
    up = done.select("document_id", "root", "top", "dist")
    above = prefixes(local, links, done)
    if counts:
        above = checkpoint(above)
    full = local.join(up, ["document_id", "root"], "left").join(above, ["document_id", "root"], "left").join(_states(local, links, done), ["document_id", "id"], "left")
    sound = ~F.coalesce(F.col("link_state").isin("cycle", "below_cycle"), F.lit(False))
    n = []
    if counts:
        sizes = local.where(F.col("id") == F.col("root")).select("document_id", "root", (F.col("below") + 1).alias("size"))
        hung = above.join(sizes, ["document_id", "root"]).select("document_id", F.explode("prefix").alias("id"), "size").groupBy("document_id", "id").agg(F.sum("size").alias("hung"))
        full = full.join(hung, ["document_id", "id"], "left")
        n = [F.when(sound, F.col("below") + F.coalesce("hung", F.lit(0))).alias("n_descendants")]
    return full.select(
        "document_id", F.col("id").alias("element_id"),
        F.when(sound, F.coalesce("top", "root")).alias("root_id"),
        F.when(sound, F.col("off") + F.coalesce("dist", F.lit(0))).alias("depth"),
        F.when(sound, F.concat(F.coalesce("prefix", F.array().cast("array<string>")), "local_path")).alias("path"),
        "link_state", *n,
    )


def descendants(tree: DataFrame) -> DataFrame:
    """document_id, ancestor_id, descendant_id, distance: every pair of a node and one below
    it (the closure; its size is the sum of depths)."""
    at = tree.where(F.col("depth") > 0).select("document_id", F.col("element_id").alias("descendant_id"), "depth", F.posexplode("path").alias("k", "ancestor_id"))
    return at.where(F.col("k") < F.col("depth")).select("document_id", "ancestor_id", "descendant_id", (F.col("depth") - F.col("k")).alias("distance"))
