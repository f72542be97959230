"""Deeply nested records to flat related tables (problem 4): adjacency-table shredding.

Any nested frame becomes one adjacency table: node, parent, label, ordinal, kind
('object', 'array' or 'scalar') and scalar (the value as a
string; timestamps as microseconds since 1970, in any time zone). The expansion is one
array expression that follows the schema and one inline: the input is read once, whatever the
number of its fields, and nothing is shuffled. Entity tables come back by joining the object nodes with
their scalars, those of nested structs by their path, and pivoting these into columns.

Defined results: a null array, struct or scalar has no node; an empty array is a node
without children; null members of arrays have no node but keep their ordinal, so the
ordinals of the others are those delivered. Records with a null key are left out. Of
several deliveries of a key the latest by the version column holds (null is the oldest;
ties go to the larger content hash, so the choice is the same on every run). Fields of
equal names in different structs don't clash: a node is known by its path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docstrata.runtime import checkpoint

ADJACENCY = "key string, node string, parent string, label string, ordinal int, kind string, scalar string"


def latest(df: DataFrame, key: str, version: str) -> DataFrame:
    """The latest delivery of each key, by partial aggregation (a key may hold any share of rows)."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    order = F.struct(F.col(version), F.xxhash64(*plain))
    kept = df.where(F.col(key).isNotNull()).select(key, F.struct("*").alias("row"), order.alias("o"))
    return kept.groupBy(key).agg(F.max_by("row", "o").alias("row")).select("row.*")


NODE = "array<struct<node:string,parent:string,label:string,ordinal:int,kind:string,scalar:string>>"


def _nodes(v: Column, kind: T.DataType, label: Column, node: Column, parent: Column, ordinal: Column, skip: set[str]) -> Column:
    """The nodes of a value and of all below it, as an array."""
    none = F.lit(None).cast("string")
    own = lambda name, scalar: F.array(F.struct(node.alias("node"), parent.alias("parent"), label.alias("label"), ordinal.cast("int").alias("ordinal"), F.lit(name).alias("kind"), scalar.alias("scalar")))
    no = F.lit(None)
    if isinstance(kind, T.StructType):
        below = [_nodes(v.getField(f.name), f.dataType, F.lit(f.name), F.concat(node, F.lit(f".{f.name}")), node, no, skip) for f in kind.fields if f.name not in skip]
        all_ = F.concat(own("object", none), *below)
    elif isinstance(kind, T.ArrayType):
        members = F.transform(v, lambda x, i: _nodes(x, kind.elementType, label, F.concat(node, F.lit("["), i.cast("string"), F.lit("]")), node, i, skip))
        all_ = F.concat(own("array", none), F.flatten(members))
    elif isinstance(kind, T.MapType):
        members = F.transform(F.map_entries(v), lambda e: _nodes(e["value"], kind.valueType, label, F.concat(node, F.lit("{"), e["key"].cast("string"), F.lit("}")), node, no, skip))
        all_ = F.concat(own("object", none), F.flatten(members))
    else:
        all_ = own("scalar", (F.unix_micros(v) if isinstance(kind, T.TimestampType) else v).cast("string"))
    return F.when(v.isNull(), F.array().cast(NODE)).otherwise(all_.cast(NODE))


def shred(df: DataFrame, key: str, entity: str, skip: set[str] = frozenset()) -> DataFrame:
    """The adjacency table of a frame whose key column is unique. The record's own node is its
    key. skip: field names that aren't followed."""
    fields = [f for f in df.schema.fields if f.name not in skip]
    root = df.select(F.col(key).cast("string").alias("key"), F.struct(*[F.col(f"`{f.name}`") for f in fields]).alias("v"))
    nodes = _nodes(F.col("v"), T.StructType(fields), F.lit(entity), F.col("key"), F.lit(None).cast("string"), F.lit(None), set(skip))
    return root.select("key", F.inline(nodes))


def entities(adjacency: DataFrame, label: str, fields: list[str]) -> DataFrame:
    """Entity table of the array members with a label: key, node, parent (the owning object, not the
    array between), ordinal, and the scalars named in fields as string columns; fields of nested structs by
    their path ('bbox.left' becomes bbox_left)."""
    objects = adjacency.where((F.col("kind") == "object") & (F.col("label") == label)).select("key", "node", F.regexp_replace("parent", r"\.[^.\[\]]+$", "").alias("owner"), "ordinal")
    path = F.regexp_extract("node", r"\]\.([^\]]*)$", 1)
    scalars = adjacency.where(F.col("kind") == "scalar").select("key", path.alias("path"), F.regexp_extract("node", r"^(.*\])\.[^\]]*$", 1).alias("node"), "scalar").where(F.col("path").isin(fields))
    wide = scalars.groupBy("key", "node").agg(*[F.max(F.when(F.col("path") == f, F.col("scalar"))).alias(f.replace(".", "_")) for f in fields])
    return objects.join(wide, ["key", "node"], "left").withColumnRenamed("owner", "parent")


def found_members(documents: DataFrame, tables: DataFrame) -> DataFrame:
    """relation, parent_key, child_pos of all non-null members of elements, provenance and cells."""
    docs = checkpoint(shred(latest(documents.select("id", "elements", "delivered_at"), "id", "delivered_at").select("id", "elements"), "id", "document", {"children_ids", "bbox", "metadata", "text", "type", "document_id", "parent_id", "reading_order", "heading_level", "confidence", "source"}))
    tabs = shred(latest(tables.select("id", "cells", "delivered_at"), "id", "delivered_at").select("id", "cells"), "id", "table", {"text", "row_span", "column_span", "is_header", "column", "row"})
    element = entities(docs, "elements", ["id"])
    provenance = docs.where((F.col("label") == "provenance") & (F.col("kind") == "object")).select("key", F.regexp_replace("parent", r"\.provenance$", "").alias("node"), F.col("ordinal").alias("child_pos"))
    owners = element.select("key", "node", F.col("id").alias("parent_key"))
    cell = tabs.where((F.col("label") == "cells") & (F.col("kind") == "object"))
    rows = [
        element.select(F.lit("element").alias("relation"), F.col("key").alias("parent_key"), F.col("ordinal").alias("child_pos")),
        provenance.join(owners, ["key", "node"]).select(F.lit("provenance").alias("relation"), "parent_key", "child_pos"),
        cell.select(F.lit("cell").alias("relation"), F.col("key").alias("parent_key"), F.col("ordinal").alias("child_pos")),
    ]
    return reduce(DataFrame.unionByName, rows).distinct()
