"""Sharding by a hierarchical weighted hash tree.

A document descends region, rack and shard: at each node every child draws a
number from the document's key and the child's name, and the child with the
greatest ln(u) / weight is taken. Each child so gets keys in proportion to its
weight, and when a child's weight grows, keys move into that child only. A
node's weight is the sum of its shards' weights.

A shard put into an existing rack would also raise the weights of its rack and
region, and keys drawn into these from outside could land in the rack's older
shards. Shards added later therefore join as regions of their own, one rack
and one shard each: then only keys that the new shard wins move, whatever the
number of shards.

Placement needs the key and the tree alone, so it is a map over the rows.
Slots come from one range sort of the narrow result.

Cases: a null text has size 16 and the checksum of no bytes; a null doc_id is
a key of its own; repeated rows share a shard and get slots of their own; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmart.llm.common import numbered, ship_code, stage, table

SHARDS = 40
#: Shards of the first tree: regions x racks x shards.
REGIONS, RACKS = 4, 2
#: What a document takes besides its text.
OVERHEAD = 16


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; only shards have a weight of their own."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int = -1
    own: float = 0.0
    weight: float = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "weight", math.fsum(c.weight for c in self.children) if self.children else self.own)


def tree(shards: int, first: int = SHARDS, weights: dict[int, float] | None = None) -> Node:
    """The first ``first`` shards dealt evenly over regions and racks; each
    later shard is a region of its own."""
    weights = weights or {}
    racks = REGIONS * RACKS

    def leaf(i: int) -> Node:
        return Node(f"shard-{i}", shard=i, own=weights.get(i, 1.0))

    regions = []
    for g in range(REGIONS):
        inside = []
        for k in range(RACKS):
            own = tuple(leaf(i) for i in range(min(shards, first)) if i * racks // first == g * RACKS + k)
            if own:
                inside.append(Node(f"rack-{g}-{k}", own))
        if inside:
            regions.append(Node(f"region-{g}", tuple(inside)))
    for i in range(first, shards):
        regions.append(Node(f"region-of-{i}", (Node(f"rack-of-{i}", (leaf(i),)),)))
    return Node("root", tuple(regions))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit keys: the finalizer of SplitMix64 (fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(name: str) -> np.uint64:
    value = 0xCBF29CE484222325  # FNV-1a, 64 bits (fixed constants)
    for byte in name.encode():
        value = ((value ^ byte) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
    return np.uint64(value)


def place(keys: np.ndarray, node: Node) -> np.ndarray:
    """The shard of each 64-bit key."""
    if not node.children:
        return np.full(len(keys), node.shard, np.int32)
    draws = np.empty((len(node.children), len(keys)))
    for i, child in enumerate(node.children):
        bits = _mixed(_mixed(keys) ^ _salt(child.name)) >> np.uint64(11)
        draws[i] = np.log((bits + 0.5) / 2.0**53) / child.weight if child.weight > 0 else -np.inf
    best = draws.argmax(axis=0)
    out = np.empty(len(keys), np.int32)
    for i, child in enumerate(node.children):
        mine = np.flatnonzero(best == i)
        if len(mine):
            out[mine] = place(keys[mine], child)
    return out


def shard(
    docs: DataFrame, shards: int = SHARDS, label: str = "shards", first: int = SHARDS, weights: dict[int, float] | None = None
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, grown_shard, slot). ``first`` is the size
    of the first tree and stays the same when shards are added, so that
    grown_shard is the shard of a call with one shard more."""
    if shards < first:
        raise ValueError(f"{shards} shards are fewer than the {first} of the first tree; name its size in first")
    ship_code(docs.sparkSession)
    now, grown = tree(shards, first, weights), tree(shards + 1, first, weights)
    bytes_ = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.octet_length(bytes_) + OVERHEAD).cast("long").alias("size"), F.crc32(bytes_).alias("text_crc32"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            keys = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            keys = np.where(ids.is_null().to_numpy(zero_copy_only=False), _salt("no doc_id"), keys)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place(keys, now)), pa.array(place(keys, grown))],
                ["doc_id", "size", "text_crc32", "shard", "grown_shard"],
            )

    placed = stage(narrow.mapInArrow(work, "doc_id long, size long, text_crc32 long, shard int, grown_shard int"), label)
    counts = {r[0]: r[1] for r in placed.groupBy("shard").count().collect()}  # a row for each shard
    before, rows = 0, []
    for s in sorted(counts):
        rows.append((s, before))
        before += counts[s]
    starts = docs.sparkSession.createDataFrame(rows, "shard int, shard_start long")
    listed = numbered(placed, ["shard", "doc_id", "size", "text_crc32"], f"{label}-slots")
    return (
        listed.join(F.broadcast(starts), "shard")  # a row for each shard
        .withColumn("slot", F.col("row_index") - F.col("shard_start"))
        .drop("row_index", "shard_start")
    )


def op9_hash_tree_shards(spark, folder: str) -> DataFrame:
    """Per document: size, checksum, shard, slot, and its shard with one shard more."""
    out = shard(table(spark, folder, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
