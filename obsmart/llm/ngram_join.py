"""N-gram Jaccard join with signature trees.

Two texts link when their sets of word shingles have a Jaccard similarity of
``least`` hundredths or more. The join is exact on 64-bit shingle hashes:

1. Texts with equal sets are one class; only classes are compared.
2. Any linked pair shares a shingle among the first few of each set, in any
   order that both use (a set of size s needs s - ceil(least * s) + 1). The
   order puts rare shingles first; how frequent each is, is counted over all
   documents in a table of fixed size, so a shingle that a third of all texts
   share comes last and heads no block but that of texts without rarer ones.
3. The classes of one such shingle form a block. Classes that differ too much
   from all others of their block, by how many shingles lie in each part of the
   hash range, leave it at once (a difference in counts is a difference in sets;
   very large blocks skip this). Blocks left with the same members, as all shingles
   of two near copies leave, are one block. What is left is a signature tree:
   classes sorted by size in leaves, and above them nodes with OR-combined
   token bitmaps and size ranges. Tree pairs are descended together; a pair of
   nodes is dropped when no two of their sets can overlap enough. Large blocks
   are cut into tiles by size, so that no task holds more than two of them.
4. Pairs that the bitmaps cannot exclude are compared shingle by shingle. Each
   set is sent once to each tile of its pairs, not to each pair: pairs connected
   with one another are dealt together, up to ``CHUNK`` sets with as many others.
   Sets are not stored: those in a pair are made again from their texts.
5. Links are joined to components by passing on the smallest class and
   jumping along labels. Tasks first reduce the links they have to a forest
   with the same components, so what is joined grows with the classes, not with
   the pairs of a large group; numbers of links are added up beside it.

Rows cross between stages packed in blocks of bytes, one for each task and
target partition; nothing is dropped, sampled or capped.

Cases: null, empty and blank texts have an empty set, link with nothing and
are components of their own; repeated texts are linked; repeated doc_ids share
the smallest; a null doc_id counts as larger than any other and is its own
component's id only where there is no other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsmart.llm.common import WORD, given_back, partition_id, partitions, ship_code, shuffles_go, slices, stage, table, unstage
from obsmart.llm.shingles import digests, shingle_sets, spread

WORDS, LEAST = 4, 85
#: Counters of the frequency table (4 bytes each) and bits of a class's bitmap.
COUNTERS, BITMAP_BITS = 1 << 20, 2048
#: Classes of a leaf, children of a node, classes of a tile.
LEAF, FAN, TILE = 32, 8, 2048
#: Sets of a comparing tile, on either side; tasks whose forests are merged in one.
CHUNK, MERGED = 1024, 12
#: Rows of (tile, class) up to which they are sent to every task, about 10 MB.
BROADCAST_ROWS = 150_000
#: Text shingled at once, in bytes; its arrays take some ten times as much.
TEXT_BYTES = 2 << 20
#: Entries that a task gathers before it passes them on.
HELD = 1 << 20
#: Parts in which tables of fixed size are added up.
PARTS = 16

#: Parts of the hash range in which each set's shingles are counted, and
#: neighbours in a block with which the counts are compared.
CELLS, NEAR = 32, 64

#: A shingle heads a block: the set's short name, its size, whether the shingle is
#: among the first few that a larger partner must meet, and its counts by cell.
ENTRY = np.dtype([("token", "<u8"), ("a", "<u8"), ("n", "<i4"), ("early", "u1"), ("cells", "u1", CELLS)])
#: Bytes of a field that are sent where not all are needed. A shingle is told apart
#: within its target partition only: 40 bits of its hash, and two that agree in
#: them are one block, which adds candidates and loses none.
SENT = {"token": 5}
PAIR = np.dtype([("a", "<u8"), ("a2", "<u8"), ("b", "<u8"), ("b2", "<u8")])


def prefix_sizes(sizes: np.ndarray, least: int) -> np.ndarray:
    """How many first shingles of each set a linked partner must meet."""
    return np.where(sizes > 0, sizes - -(-least * sizes // 100) + 1, 0)


def freed(work: Callable) -> Callable:
    return lambda batches: given_back(work(batches))


def early_sizes(sizes: np.ndarray, least: int) -> np.ndarray:
    """How many first shingles of each set a partner that is as large must meet."""
    return np.where(sizes > 0, sizes - -(-2 * least * sizes // (100 + least)) + 1, 0)


def field_bytes(rows: np.ndarray, name: str) -> np.ndarray:
    """The bytes of a field, little-endian, a line for each row."""
    return np.ascontiguousarray(rows[name]).view(np.uint8).reshape(len(rows), -1)


def near_mean(rows: np.ndarray, way: int) -> np.ndarray:
    """Counts by cell as what they differ from their mean by (modulo 256), or back:
    these are alike in sets of any size, and so take fewer bytes."""
    if "cells" in rows.dtype.names:
        rows = rows.copy()
        rows["cells"] += (way * (rows["n"] // CELLS)).astype(np.uint8)[:, None]
    return rows


def squeezed(rows: np.ndarray) -> bytes:
    """Rows as one compressed frame a field: small numbers lie apart from hashes."""
    pack = zstandard.ZstdCompressor(level=1).compress
    rows = near_mean(rows, -1)
    frames = [pack(field_bytes(rows, f)[:, : SENT.get(f)].tobytes()) for f in rows.dtype.names]
    return np.array([len(rows), *map(len, frames)], "<u4").tobytes() + b"".join(frames)


def expanded(data: bytes, kind: np.dtype) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor().decompress
    n, *lengths = np.frombuffer(data, "<u4", 1 + len(kind.names)).tolist()
    rows, at = np.empty(n, kind), 4 * (1 + len(kind.names))
    for f, length in zip(kind.names, lengths, strict=True):
        column = np.zeros((n, kind[f].itemsize), np.uint8)
        column[:, : SENT.get(f)] = np.frombuffer(unpack(data[at : at + length]), np.uint8).reshape(n, -1)
        rows[f] = column.view(kind[f].base).reshape(rows[f].shape)
        at += length
    return near_mean(rows, 1)


def packed(rows: np.ndarray, target: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows sorted by target partition, one row of bytes for each."""
    order = np.argsort(target, kind="stable")
    rows, target = rows[order], target[order]
    first = np.flatnonzero(np.diff(target, prepend=-1))
    if len(first):
        blobs = [squeezed(part) for part in np.split(rows, first[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(target[first].astype(np.int32)), pa.array(blobs, pa.binary())], ["part", "data"])


def unpacked(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> np.ndarray:
    found = [expanded(b, kind) for batch in batches for b in batch.column("data").to_pylist()]
    return np.concatenate(found) if found else np.zeros(0, kind)


def piece_bytes(piece: np.ndarray) -> bytes:
    """Numbers as one compressed frame, their lowest bytes first: every task sends a
    table, in which most numbers are small."""
    return zstandard.ZstdCompressor(level=1).compress(piece.view(np.uint8).reshape(len(piece), -1).T.tobytes())


def piece_numbers(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def added_up(rows: DataFrame, kind: str, how: Callable) -> np.ndarray:
    """A table of fixed size from (part, data) pieces of each task, as ``piece_bytes`` made them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                piece = piece_numbers(data, kind)
                held[part] = how(held[part], piece) if part in held else piece.copy()
        if held:
            columns = [pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "data"])

    summed = rows.repartitionById(PARTS, F.col("part")).mapInArrow(freed(work), "part int, data binary")
    with shuffles_go(rows.sparkSession):
        summed = summed.collect()  # PARTS rows
    return np.concatenate([np.frombuffer(r.data, kind) for r in sorted(summed, key=lambda r: r.part)]) if summed else np.zeros(0, kind)


def set_bytes(numbers: np.ndarray) -> bytes:
    """A set to compare with others: the upper 56 bits of its numbers. That two
    different shingles of a pair of sets of 1,000 agree in these happens once in 10^11 pairs."""
    return np.ascontiguousarray((numbers >> np.uint64(8)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def set_numbers(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(blob, np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel()


def key(pairs: np.ndarray) -> pa.Array:
    """Classes as 16 bytes that sort alike everywhere."""
    flat = np.ascontiguousarray(pairs.astype(">u8"))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(pairs), [None, pa.py_buffer(flat)]).cast(pa.binary())


def halves(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").reshape(-1, 2).astype(np.uint64)


# --- signature trees -------------------------------------------------------


class Tree:
    """Levels of nodes over classes sorted by size: smallest and largest size,
    fewest bits, OR of the bitmaps. Level 0 holds the classes themselves."""

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray):
        pops = np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
        self.levels = [(sizes, sizes, pops, bitmaps)]
        self.fans = []
        fan = LEAF
        while len(self.levels[-1][0]) > 1:
            low, high, few, bits = self.levels[-1]
            starts = np.arange(0, len(low), fan)
            self.levels.append(
                (np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.minimum.reduceat(few, starts), np.bitwise_or.reduceat(bits, starts))
            )
            self.fans.append(fan)
            fan = FAN


def may_link(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, least: int) -> np.ndarray:
    """Node pairs whose largest possible overlap still allows a link."""
    shared = np.bitwise_count(x[3][i] & y[3][j]).sum(axis=1, dtype=np.int64)
    most = np.minimum(x[1][i] - np.maximum(0, x[2][i] - shared), y[1][j] - np.maximum(0, y[2][j] - shared))
    return (100 + least) * most >= least * (x[0][i] + y[0][j])


def tree_pairs(a: Tree, b: Tree | None, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of class pairs, from one tree (b is None) or two, that their
    bitmaps and sizes don't exclude."""
    same, b = b is None, b or a
    up_a, up_b = len(a.levels) - 1, len(b.levels) - 1
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def opened(which: np.ndarray, other: np.ndarray, fan: int, total: int) -> tuple[np.ndarray, np.ndarray]:
        kids = (which[:, None] * fan + np.arange(fan)).ravel()
        other = np.repeat(other, fan)
        return kids[kids < total], other[kids < total]

    while up_a or up_b:
        if up_a >= up_b:
            up_a -= 1
            i, j = opened(i, j, a.fans[up_a], len(a.levels[up_a][0]))
            if same:
                up_b -= 1
                j, i = opened(j, i, b.fans[up_b], len(b.levels[up_b][0]))
                i, j = i[i <= j], j[i <= j]
        else:
            up_b -= 1
            j, i = opened(j, i, b.fans[up_b], len(b.levels[up_b][0]))
        kept = []
        for at in range(0, len(i), 1 << 16):  # bounds the bitmaps in memory
            part = slice(at, at + (1 << 16))
            kept.append(may_link(a.levels[up_a], b.levels[up_b], i[part], j[part], least))
        keep = np.concatenate(kept) if kept else np.zeros(0, bool)
        i, j = i[keep], j[keep]
    if same:
        i, j = i[i < j], j[i < j]
    kept = []
    for at in range(0, len(i), 1 << 16):
        p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        x, y = a.levels[0], b.levels[0]
        apart = np.bitwise_count(x[3][p] ^ y[3][q]).sum(axis=1, dtype=np.int64)  # at most the sets' difference
        n, m = x[0][p], y[0][q]
        kept.append(((100 + least) * apart <= (100 - least) * (n + m)) & (100 * np.minimum(n, m) >= least * np.maximum(n, m)))
    keep = np.concatenate(kept) if kept else np.zeros(0, bool)
    return i[keep], j[keep]


# --- stages ------------------------------------------------------------------


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, c) of every document, and (part, data) of the frequency table."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        names = ["doc_id", "n", "c", "a", "part", "data"]
        for batch in batches:
            for first, text in slices(batch.column(1), TEXT_BYTES):
                numbers, sizes = shingle_sets(text, words)
                counts += np.bincount((numbers >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64), minlength=COUNTERS)
                rows, digest = len(text), digests(numbers, sizes)
                short = pa.array(digest[:, 0].copy().view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(sizes), key(digest), short, pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names
                )
        if counts.any():
            pieces = [piece_bytes(p) for p in np.split(np.minimum(counts, 2**32 - 1).astype("<u4"), PARTS)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(PARTS, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.int64())], pa.array(range(PARTS), pa.int32()), pa.array(pieces, pa.binary())], names
            )

    return docs.mapInArrow(freed(work), "doc_id long, n long, c binary, a long, part int, data binary")


def _blocks(docs: DataFrame, words: int, least: int, levels, parts: int) -> DataFrame:
    """(block, a, n, cut, first, last, cuts): the classes, by their short names, of
    every block of two or more. A large block is cut by size, and a member of
    ``cut`` meets the cuts from ``first`` to ``last``; ``tiled`` gives it a row for
    each. Short names that two classes share only add candidates. A block is named
    by its members and their cuts: those with the same ones compare the same
    pairs, and come once from a task, more than once from several."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = levels.value.astype(np.uint64) << np.uint64(56)
        seen: set[int] = set()
        held, amount = [], 0
        for batch in batches:
            for _, text in slices(batch.column(0), TEXT_BYTES):
                numbers, sizes = shingle_sets(text, words)
                names = digests(numbers, sizes)[:, 0]
                need, early = prefix_sizes(sizes, least), early_sizes(sizes, least)
                begin = np.cumsum(sizes) - sizes
                mixed = spread(numbers)
                order = rank[(numbers >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)] | (mixed >> np.uint64(8))
                cell = (mixed % np.uint64(CELLS)).astype(np.int64)
                for k, name in enumerate(names.tolist()):
                    if not sizes[k] or name in seen:
                        continue
                    seen.add(name)
                    part = slice(begin[k], begin[k] + sizes[k])
                    first = np.argsort(order[part])[: need[k]]
                    rows = np.empty(len(first), ENTRY)
                    rows["token"], rows["a"], rows["n"] = numbers[part][first], name, sizes[k]
                    rows["early"] = np.arange(len(first)) < early[k]
                    rows["cells"] = np.minimum(np.bincount(cell[part], minlength=CELLS), 255)
                    held.append(rows)
                    amount += len(rows)
                if len(seen) > HELD:
                    seen.clear()  # it only saves repeating copies
            if amount > HELD // 4:
                rows = np.concatenate(held)
                yield from packed(rows, spread(rows["token"]) % np.uint64(parts))
                held, amount = [], 0
        if held:
            rows = np.concatenate(held)
            yield from packed(rows, spread(rows["token"]) % np.uint64(parts))

    def partnered(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Rows that some row of their block may link with; all of a large block."""
        alive = np.repeat(lengths > NEAR, lengths)
        some = np.flatnonzero(np.repeat((lengths > 1) & (lengths <= NEAR), lengths))
        for step in range(1, NEAR):
            some = some[some + step < len(rows)]
            some = some[rows["token"][some] == rows["token"][some + step]]
            if not len(some):
                break
            x, y = rows[some], rows[some + step]
            close = (100 * x["n"].astype(np.int64) >= least * y["n"].astype(np.int64)) & (x["early"] > 0)
            x, y, at = x[close], y[close], some[close]
            apart = np.abs(x["cells"].astype(np.int16) - y["cells"].astype(np.int16)).sum(axis=1, dtype=np.int64)
            at = at[(100 + least) * apart <= (100 - least) * (x["n"].astype(np.int64) + y["n"])]
            alive[at] = alive[at + step] = True
        return alive

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = unpacked(batches, ENTRY)

        def runs() -> tuple[np.ndarray, np.ndarray]:
            starts = np.flatnonzero(np.concatenate([[True], rows["token"][1:] != rows["token"][:-1]])) if len(rows) else np.zeros(0, np.int64)
            return starts, np.diff(np.append(starts, len(rows)))

        rows = rows[np.argsort(rows["token"], kind="stable")]
        _, lengths = runs()
        rows = rows[np.repeat(lengths > 1, lengths)]
        # by size, the larger of two being the later; of equal sizes, those last whose shingle isn't early
        rows = rows[np.lexsort((rows["a"], 1 - rows["early"], rows["n"], rows["token"]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows["token"][1:] != rows["token"][:-1]) | (rows["a"][1:] != rows["a"][:-1])
        rows = rows[new]
        rows = rows[partnered(rows, runs()[1])]
        starts, lengths = runs()

        place = np.arange(len(rows)) - np.repeat(starts, lengths)
        cut = place // TILE
        name = np.add.reduceat(spread(rows["a"] + cut.astype(np.uint64)), starts) if len(rows) else np.zeros(0, np.uint64)
        once = np.zeros(len(starts), bool)
        once[np.unique(name, return_index=True)[1]] = True
        once &= lengths > 1
        block = np.repeat(name, lengths)

        def out(part: np.ndarray, first: np.ndarray, last: np.ndarray, cuts: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(block[part].view(np.int64)), pa.array(rows["a"][part].view(np.int64)), pa.array(rows["n"][part].astype(np.int64)),
                 *(pa.array(x.astype(np.int32)) for x in (cut[part], first, last, np.full(len(part), cuts)))],
                ["block", "a", "n", "cut", "first", "last", "cuts"],
            )

        some = np.flatnonzero(np.repeat(once & (lengths <= TILE), lengths))
        for at in range(0, len(some), 1 << 16):
            part = some[at : at + (1 << 16)]
            none = np.zeros(len(part), np.int32)
            yield out(part, none, none, 1)
        large = once & (lengths > TILE)
        for start, length in zip(starts[large].tolist(), lengths[large].tolist(), strict=True):
            begin = np.arange(0, length, TILE)
            low = rows["n"][start + begin].astype(np.int64)
            high = rows["n"][start + np.minimum(begin + TILE, length) - 1].astype(np.int64)
            # sorted by size: a cut meets those whose smallest set its largest still may link with
            last = np.searchsorted(least * low, 100 * high, "right") - 1
            first = np.searchsorted(100 * high, least * low, "left")
            for k, at in enumerate(begin.tolist()):
                part = np.arange(start + at, start + min(at + TILE, length))
                yield out(part, np.full(len(part), first[k]), np.full(len(part), last[k]), len(begin))

    dealt = docs.select("text").mapInArrow(freed(put), "part int, data binary").repartitionById(parts, F.col("part"))
    return dealt.mapInArrow(freed(get), "block long, a long, n long, cut int, first int, last int, cuts int")


def once(blocks: DataFrame, parts: int) -> DataFrame:
    """The members of each block, those of several tasks' like blocks once; dealt
    by class, as the join that follows needs them."""
    return blocks.repartition(parts, "a").dropDuplicates(["block", "a", "cut"])


def tiled(members: DataFrame) -> DataFrame:
    """A row for each tile of a member, where it stands wherever the join before
    has put it: a tile pairs side 0, the smaller sets, with side 1, or side 0 with
    itself."""
    met = members.select("*", F.explode(F.sequence("first", "last")).alias("other"))
    low, high = F.least("cut", "other"), F.greatest("cut", "other")
    tile = low.cast("long") * F.col("cuts") + high
    return met.select("block", tile.alias("tile"), (F.col("other") < F.col("cut")).cast("int").alias("side"), "n", "c", "bitmap")


def _known(spark: SparkSession, ids: DataFrame) -> tuple[object, int]:
    """A Bloom filter of doc ids, of a size between 1 and 16 MB."""
    bits = 1 << min(27, max(23, (16 * ids.count()).bit_length()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits, bool)
        for batch in batches:
            x = batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for k in range(3):
                held[spread(x + np.uint64(k)) % np.uint64(bits)] = True
        pieces = [piece_bytes(p) for p in np.split(np.packbits(held), PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(pieces, pa.binary())], ["part", "data"])

    table_ = added_up(ids.mapInArrow(freed(work), "part int, data binary"), "u1", np.bitwise_or)
    return spark.sparkContext.broadcast(table_), bits


def in_filter(ids: pa.Array, known: np.ndarray, bits: int) -> np.ndarray:
    """Which ids ``_known`` lets through: all that it was given, all nulls, few others."""
    x = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    found = np.ones(len(x), bool)
    for k in range(3):
        place = spread(x + np.uint64(k)) % np.uint64(bits)
        found &= (known[place >> np.uint64(3)] >> (np.uint64(7) - (place & np.uint64(7))).astype(np.uint8)) & np.uint8(1) > 0
    return found | ids.is_null().to_numpy(zero_copy_only=False)


def sets_of(batches: Iterator[pa.RecordBatch], words: int, known, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingle sets of the documents (doc_id, text) whose id may be wanted."""
    for batch in batches:
        hit = in_filter(batch.column(0), known.value, bits)
        for _, text in slices(batch.column(1).filter(pa.array(hit)), TEXT_BYTES):
            yield shingle_sets(text, words)


def _candidates(docs: DataFrame, words: int, known, bits: int) -> DataFrame:
    """(c, a, bitmap) of the documents whose id may be wanted."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, sizes in sets_of(batches, words, known, bits):
            names = digests(numbers, sizes)
            maps = np.zeros((len(sizes), BITMAP_BITS), bool)
            maps[np.repeat(np.arange(len(sizes)), sizes), (spread(numbers) % np.uint64(BITMAP_BITS)).astype(np.int64)] = True
            some = np.flatnonzero(sizes)
            yield pa.RecordBatch.from_arrays(
                [key(names[some]), pa.array(names[some, 0].view(np.int64)), pa.array([m.tobytes() for m in np.packbits(maps[some], axis=1)], pa.binary())], ["c", "a", "bitmap"]
            )

    return docs.select("doc_id", "text").mapInArrow(freed(work), "c binary, a long, bitmap binary")


def _compared(docs: DataFrame, words: int, known, bits: int) -> DataFrame:
    """(c, numbers) of the documents whose id may be wanted."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, sizes in sets_of(batches, words, known, bits):
            ends, some = np.cumsum(sizes), np.flatnonzero(sizes)
            sets = [set_bytes(numbers[ends[k] - sizes[k] : ends[k]]) for k in some.tolist()]
            yield pa.RecordBatch.from_arrays([key(digests(numbers, sizes)[some]), pa.array(sets, pa.binary())], ["c", "numbers"])

    return docs.select("doc_id", "text").mapInArrow(freed(work), "c binary, numbers binary")


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(others, smallest): what the pairs connect, as pairs of each name with
    the smallest of its component."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(names)))

    def head(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(ends[: len(a)].tolist(), ends[len(a) :].tolist(), strict=True):
        x, y = head(x), head(y)
        parent[max(x, y)] = min(x, y)
    heads = np.fromiter(map(head, range(len(names))), np.int64, len(names))
    some = np.flatnonzero(heads != np.arange(len(names)))
    return names[some], names[heads[some]]


def binary(names: np.ndarray) -> pa.Array:
    flat = pa.py_buffer(np.ascontiguousarray(names))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(names), [None, flat]).cast(pa.binary())


def _names(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), "V16")


def merged_forests(edges: DataFrame, parts: int, label: str) -> DataFrame:
    """(a, b) from (part, a, b): the forests of ``MERGED`` tasks as one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(batches, pa.schema([("a", pa.binary()), ("b", pa.binary())])).combine_chunks()
        if found.num_rows:
            others, smallest = stars(_names(found["a"]), _names(found["b"]))
            yield pa.RecordBatch.from_arrays([binary(others), binary(smallest)], ["a", "b"])

    few = max(1, -(-parts // MERGED))
    dealt = edges.repartitionById(few, F.pmod("part", F.lit(few))).select("a", "b")
    return stage(dealt.mapInArrow(freed(work), "a binary, b binary"), label)


def _pairs(tiles: DataFrame, least: int, parts: int) -> DataFrame:
    """The pairs that no signature tree excludes, a before b: (a, bs) with all
    partners of a class in one row, and (part, a, b) of each task's forest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, amount = [], 0

        def rows(names: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
            x, y = names[i], names[j]
            other = (x != y).any(axis=1)
            x, y = x[other], y[other]
            less = (x[:, 0] < y[:, 0]) | ((x[:, 0] == y[:, 0]) & (x[:, 1] < y[:, 1]))
            x, y = np.where(less[:, None], x, y), np.where(less[:, None], y, x)
            out = np.empty(len(x), PAIR)
            out["a"], out["a2"], out["b"], out["b2"] = x[:, 0], x[:, 1], y[:, 0], y[:, 1]
            return out

        def compare(group: list[pa.RecordBatch]) -> None:
            nonlocal amount
            found = pa.Table.from_batches(group).combine_chunks().to_batches()[0]
            names = halves(found.column("c"))
            sizes = found.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
            maps = np.frombuffer(b"".join(found.column("bitmap").to_pylist()), np.uint64).reshape(len(sizes), -1)
            side = found.column("side").to_numpy(zero_copy_only=False)
            first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if len(second):
                i, j = tree_pairs(Tree(sizes[first], maps[first]), Tree(sizes[second], maps[second]), least)
                i, j = first[i], second[j]
            else:
                i, j = tree_pairs(Tree(sizes, maps), None, least)
            if len(i):
                held.append(rows(names, i, j))
                amount += len(i)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, amount
            if held:
                found = np.unique(np.concatenate(held))
                yield from packed(found, spread(found["a"]) % np.uint64(parts))
            held, amount = [], 0

        group: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            block = batch.column("block").to_numpy(zero_copy_only=False)
            tile = batch.column("tile").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(tile) != 0)) + 1
            edges = [0, *cuts.tolist(), len(block)]
            for begin, end in zip(edges[:-1], edges[1:], strict=True):
                if begin == end:
                    continue
                name = (block[begin], tile[begin])
                if group and name != last:
                    compare(group)
                    group = []
                    if amount > HELD:
                        yield from flush()
                last = name
                group.append(batch.slice(begin, end - begin))
        if group:
            compare(group)
        yield from flush()

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = partition_id()
        found = np.unique(unpacked(batches, PAIR))
        a = np.stack([found["a"], found["a2"]], axis=1)
        b = np.stack([found["b"], found["b2"]], axis=1)
        if not len(found):
            return
        starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]).any(axis=1)]))
        big = np.ascontiguousarray(b.astype(">u8"))
        lists = [x.tobytes() for x in np.split(big, starts[1:])]
        n = len(starts)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), key(a[starts]), pa.nulls(n, pa.binary()), pa.array(lists, pa.binary())], ["part", "a", "b", "bs"])
        others, smallest = stars(np.ascontiguousarray(a.astype(">u8")).view("V16").ravel(), big.view("V16").ravel())
        n = len(others)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), binary(others), binary(smallest), pa.nulls(n, pa.binary())], ["part", "a", "b", "bs"])

    dealt = tiles.mapInArrow(freed(work), "part int, data binary").repartitionById(parts, F.col("part"))
    return dealt.mapInArrow(freed(distinct), "part int, a binary, b binary, bs binary")


def _tiles(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Deal pairs to tiles of their group: (tile, pairs) in packed form, and
    (tile, c) for each set that a tile needs."""

    def chunk(names: np.ndarray, chunks: int) -> np.ndarray:
        return (spread(names[:, 0] ^ np.uint64(chunks)) % np.uint64(chunks)).astype(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tiles, packed_, wanted = [], [], set()
            for a, bs, root, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chunks = -(-m // CHUNK)
                b = np.frombuffer(bs, ">u8").reshape(-1, 2).astype(np.uint64)
                i = int(chunk(np.frombuffer(a, ">u8").reshape(1, 2).astype(np.uint64), chunks)[0])
                j = chunk(b, chunks)
                for k in np.unique(j).tolist():
                    tile = root + np.array([min(i, k), max(i, k)], ">u4").tobytes()
                    mine = np.frombuffer(bs, "V16")[j == k]
                    tiles.append(tile)
                    packed_.append(a + mine.tobytes())
                    wanted.update((tile, x) for x in (a, *mine.tolist()))
            n, m = len(tiles), len(wanted)
            names = sorted(wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*tiles, *(t for t, _ in names)], pa.binary()), pa.array([*[None] * n, *(bytes(c) for _, c in names)], pa.binary()), pa.array([*packed_, *[None] * m], pa.binary())],
                ["tile", "c", "pairs"],
            )

    rows = pairs.join(groups, pairs["a"] == groups["c"]).select("a", "bs", "root", "m")
    return rows.mapInArrow(freed(work), "tile binary, c binary, pairs binary")


def _linked(tiles: DataFrame, needed: DataFrame, sets: DataFrame, least: int, parts: int) -> DataFrame:
    """Links among the tiles' pairs: (part, a, b) of each task's forest, and
    (a, linked): rows of other classes that a class links with."""
    small = needed.count() <= BROADCAST_ROWS
    needed = sets.join(F.broadcast(needed) if small else needed, "c").select("tile", "c", "copies", "numbers")
    listed = tiles.where("c is null").select("tile", "c", F.lit(0).cast("long").alias("copies"), F.col("pairs").alias("numbers"))
    dealt = listed.union(needed).repartition(parts, "tile").sortWithinPartitions("tile", F.col("c").asc_nulls_first())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = partition_id()

        def compare(listed: list[bytes], own: dict[bytes, tuple[int, np.ndarray]]) -> pa.RecordBatch:
            a, b, linked = [], [], dict[bytes, int]()
            for row in listed:
                x, (copies, mine) = row[:16], own[row[:16]]
                for at in range(16, len(row), 16):
                    y = row[at : at + 16]
                    more, numbers = own[y]
                    small, large = (mine, numbers) if len(mine) < len(numbers) else (numbers, mine)
                    place = np.searchsorted(large, small)
                    place[place == len(large)] = 0
                    shared = int((large[place] == small).sum())
                    if 100 * shared >= least * (len(mine) + len(numbers) - shared):
                        a.append(x)
                        b.append(y)
                        linked[x] = linked.get(x, 0) + more
                        linked[y] = linked.get(y, 0) + copies
            others, smallest = stars(np.array(a, "V16"), np.array(b, "V16"))
            n, m = len(others), len(linked)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * n + [None] * m, pa.int32()), pa.array([*map(bytes, others.tolist()), *linked], pa.binary()),
                 pa.array([*map(bytes, smallest.tolist()), *[None] * m], pa.binary()), pa.array([None] * n + list(linked.values()), pa.int64())],
                ["part", "a", "b", "linked"],
            )

        last, listed, own = None, [], {}
        for batch in batches:
            for tile, c, copies, numbers in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if tile != last:
                    if listed:
                        yield compare(listed, own)
                    last, listed, own = tile, [], {}
                if c is None:
                    listed.append(numbers)
                else:
                    own[c] = (copies, set_numbers(numbers))
        if listed:
            yield compare(listed, own)

    return dealt.mapInArrow(freed(work), "part int, a binary, b binary, linked long")


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(c, root) of every class in a link: the smallest class it reaches. Each
    round takes the neighbours' smallest label, then the label's own label; both
    sides of a join are stored tables, so a heavy label can be split."""
    both = stage(links.select("a", "b").union(links.select("b", "a")).toDF("x", "y"), f"{label}-links")
    labels = stage(both.groupBy(F.col("x").alias("c")).agg(F.least(F.min("y"), F.col("c")).alias("root")), label)
    state = None
    while True:
        passed = both.join(labels, both["x"] == labels["c"]).select(F.col("y").alias("c"), "root")
        nearer = stage(passed.union(labels).groupBy("c").agg(F.min("root").alias("root")), label)
        heads = nearer.select(F.col("c").alias("root"), F.col("root").alias("head"))
        labels = stage(nearer.join(heads, "root", "left").select("c", F.coalesce("head", "root").alias("root")), label)
        found = labels.agg(F.count(F.lit(1)), F.sum(F.xxhash64("c", "root").cast("decimal(38,0)"))).first()
        if found == state:
            return labels
        state = found


def join(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row; n_links counts
    the other rows that it links with."""
    sets, classes, roots, links = _classes(docs, words, least)
    degree = links.where("linked is not null").groupBy(F.col("a").alias("c")).agg(F.sum("linked").alias("linked"))
    return _result(sets, classes, roots, stage(degree, "join-degrees"))


def _classes(docs: DataFrame, words: int, least: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The rows' sets, their classes, the root of each class in a link, and the
    compared tiles with the numbers of links."""
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    ship_code(spark)
    parts = partitions(spark)
    read = stage(_sets(docs, words), "join-sets")
    counts = added_up(read.where("part is not null").select("part", "data"), "<u4", np.add)
    levels = np.zeros(COUNTERS, np.uint8)
    if len(counts):
        levels = np.floor(4 * np.log2(counts.astype(np.float64) + 1)).astype(np.uint8)
    levels = spark.sparkContext.broadcast(levels)
    sets = read.where("part is null").select("doc_id", "n", "c", "a")
    classes = stage(
        sets.where("n > 0").groupBy("c", "a").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "join-classes"
    )
    blocks = stage(_blocks(docs, words, least, levels, parts), "join-blocks")
    wanted = stage(classes.join(blocks.select("a").distinct(), "a", "left_semi").select("first_id"), "join-wanted")
    known, bits = _known(spark, wanted)
    found = stage(_candidates(docs, words, known, bits), "join-candidates")
    maps = found.dropDuplicates(["c"])
    tiles = tiled(once(blocks, parts).join(maps, "a"))
    dealt = tiles.repartition(parts, "block", "tile").sortWithinPartitions("block", "tile", "n", "c")
    pairs = stage(_pairs(dealt, least, parts), "join-pairs")
    unstage(blocks, wanted, found)
    groups = _groups(merged_forests(pairs.where("b is not null").select("part", "a", "b"), parts, "join-pair-forest"))
    dealt = stage(_tiles(pairs.where("bs is not null").select("a", "bs"), groups), "join-tiles")
    unstage(pairs)
    needed = stage(dealt.where("c is not null").select("tile", "c").distinct().join(classes.select("c", "copies", "first_id"), "c"), "join-needed")
    known, bits = _known(spark, needed.select("first_id").distinct())
    links = stage(_linked(dealt, needed.drop("first_id"), _compared(docs, words, known, bits), least, parts), "join-links")
    unstage(dealt, needed)
    edges = merged_forests(links.where("b is not null").select("part", "a", "b"), parts, "join-link-forest")
    return sets, classes, components(edges), links


def _groups(edges: DataFrame) -> DataFrame:
    """(c, root, m): each class's group of connected pairs, and its classes."""
    roots = components(edges, "join-groups")
    sizes = stage(roots.groupBy("root").agg(F.count(F.lit(1)).alias("m")), "join-group-sizes")
    return stage(roots.join(sizes, "root").select("c", "root", "m"), "join-groups")


def _result(sets: DataFrame, classes: DataFrame, roots: DataFrame, degree: DataFrame) -> DataFrame:
    named = roots.join(classes.select("c", "first_id"), "c")
    least_id = stage(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "join-named")
    of_class = stage(
        classes.join(stage(roots.join(least_id, "root").select("c", "component_id"), "join-roots"), "c", "left")
        .join(degree, "c", "left")
        .select(
            "c",
            F.coalesce("component_id", "first_id").alias("component_id"),
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        ),
        "join-result",
    )
    alone = sets.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    linked = sets.where("n > 0").join(of_class, "c").select("doc_id", "n", "component_id", "n_links")
    return linked.union(alone).withColumnRenamed("n", "n_shingles")


def representatives(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """One row of each group of linked rows, with its columns: that of the
    smallest doc_id (null is larger than any other), then of the smallest class,
    then of the smallest hash of the row. Rows without words are groups of
    their own. Ids need not be distinct: rows are told apart by id and class.
    Rows whose id a filter of the dropped or repeated rows' ids lets through are
    given their class again, and only those that a filter of the staying ids and
    classes lets through are shuffled, to be looked up exactly."""
    spark = docs.sparkSession
    sets, classes, roots, _ = _classes(docs, words, least)
    named = roots.join(classes.select("c", "first_id"), "c")
    best = named.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "c")).alias("best"))
    lost = stage(named.join(stage(best, "join-best"), "root").where("c <> best.c").select("c"), "join-lost")
    odd = lost.union(classes.where("copies > 1").select("c")).distinct()
    odd_ids = stage(sets.where("n > 0").join(odd, "c", "left_semi").select("doc_id").where("doc_id is not null").distinct(), "join-odd")
    known, bits = _known(spark, odd_ids)

    @F.pandas_udf("boolean")
    def listed(ids: pd.Series) -> pd.Series:
        return pd.Series(in_filter(pa.array(ids, pa.int64(), from_pandas=True), known.value, bits))

    def named_row(c: str, doc_id: str):
        return F.concat(F.col(c), F.coalesce(F.col(doc_id).cast("string"), F.lit("~")).cast("binary"))

    staying = classes.join(lost, "c", "left_anti").where(listed("first_id"))
    mixed = F.col("a").bitwiseXOR(F.coalesce("first_id", F.lit(-1)))
    staying = stage(staying.select(named_row("c", "first_id").alias("k"), mixed.alias("x")), "join-staying")
    wanted, wanted_bits = _known(spark, staying.select("x"))

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(wanted.value).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(batch.column(1), known.value, bits)))
            ids = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for first, text in slices(batch.column(0).field("text"), TEXT_BYTES):
                names = digests(*shingle_sets(text, words))
                x = names[:, 0] ^ ids[first : first + len(text)]
                may_stay = pa.array(np.all([held[spread(x + np.uint64(k)) % np.uint64(wanted_bits)] for k in range(3)], axis=0))
                part = batch.slice(first, len(text))
                columns = [c.filter(may_stay) for c in (part.column(0), part.column(1), key(names))]
                yield pa.RecordBatch.from_arrays(columns, ["row", "id", "c"])

    rows = docs.select(F.struct("*").alias("row"), docs["doc_id"].alias("id"))
    worded = F.coalesce("row.text", F.lit("")).rlike(WORD)
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("id", T.LongType()), T.StructField("c", T.BinaryType())])
    # one function a stage: a second one would need a second worker beside each task, kept through the next stages
    found = rows.where(worded).mapInArrow(freed(classed), schema).withColumn("k", named_row("c", "id"))
    one = found.groupBy("k").agg(F.min_by("row", F.xxhash64("row")).alias("row")).join(staying, "k", "left_semi")
    return rows.where(~(worded & listed("id"))).select("row.*").union(one.select("row.*"))


def op5_signature_tree_join(spark, folder: str) -> DataFrame:
    """Per document: size of its shingle set and its component of links."""
    return join(table(spark, folder, "documents"))
