"""Packing token ids into windows by multiway differencing.

Each partition of documents is packed where it lies, block after block of
about ``BLOCK_WINDOWS`` windows, so no row is shuffled and no task holds more
than two blocks. Whole windows of long documents are cut off first; the rest
goes through the Karmarkar-Karp method for many ways: every piece starts as a
partial partition (its length and otherwise empty windows), and the two
partial partitions with the largest imbalance are merged again and again,
fullest windows of one onto emptiest of the other. If a window of the result
exceeds its capacity, the block gets one more window; where large pieces keep
more than a few windows part-empty, they are halved.

Cases: a null or empty text is its end id alone; repeated rows are packed
each; a document longer than any block is cut as it comes; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmart.llm.common import given_back, partition_id, ship_code, slices, table
from obsmart.llm.tokens import encoder, tokenizer_path

WINDOW = 4096
#: Windows of a block, and pieces at which it is packed at the latest.
BLOCK_WINDOWS, BLOCK_PIECES = 192, 6000
#: Share of windows beyond the least possible number at which pieces are halved.
SPARE = 0.02


def differencing(lengths: np.ndarray, ways: int) -> np.ndarray:
    """The window, from 0 to ``ways`` - 1, of each length.

    A partial partition is kept as its window sums in falling order, less the
    smallest, together with the two it was merged from and how their windows
    were paired; following the pairs down from the last merge places the pieces.
    """
    n = len(lengths)
    if ways == 1 or n == 0:
        return np.zeros(n, np.int64)
    sums: dict[int, np.ndarray] = {}  # of the partial partitions that are left; a piece alone needs none
    narrow = np.uint16 if ways <= 1 << 16 else np.int64
    parents: list[tuple[int, int, np.ndarray]] = []

    def taken(k: int) -> np.ndarray:
        if k >= n:
            return sums.pop(k)
        alone = np.zeros(ways, np.int64)
        alone[0] = lengths[k]
        return alone

    heap = [(-int(v), i) for i, v in enumerate(lengths)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = taken(a) + taken(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        new = n + len(parents)
        sums[new] = both - both[-1]
        parents.append((a, b, order.astype(narrow)))
        heapq.heappush(heap, (-int(sums[new][0]), new))
    windows = {heap[0][1]: np.arange(ways)}
    placed = np.zeros(n, np.int64)
    for k in range(len(parents) - 1, -1, -1):
        a, b, order = parents[k]
        mine = windows.pop(n + k)
        first = np.empty(ways, np.int64)
        first[order] = mine
        for child, own in ((a, first), (b, first[::-1])):
            if child < n:
                placed[child] = own[0]
            else:
                windows[child] = own
    return placed


def windows_for(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece's item, piece's length, piece's window): the fewest near-equal
    windows, rising from the least possible number, that hold all items."""
    item = np.arange(len(lengths))
    least = max(1, -(-int(lengths.sum()) // capacity))
    ways = least
    while True:
        placed = differencing(lengths, ways)
        fullest = int(np.bincount(placed, lengths, ways).max()) if len(lengths) else 0
        if fullest <= capacity:
            return item, lengths, placed
        ways += 1
        if ways > least + max(2, SPARE * least) and (large := lengths > capacity // 8).any():
            half = lengths // 2
            item = np.concatenate([item, item[large]])
            lengths = np.concatenate([np.where(large, half, lengths), (lengths - half)[large]])
            ways = least


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every
    piece; ids as little-endian unsigned 32-bit integers."""
    path = tokenizer or tokenizer_path()
    ship_code(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, base, used = encoder(path), partition_id() << 32, 0
        waiting: list[tuple[int | None, int, int, np.ndarray]] = []  # doc_id, start, doc_tokens, ids
        held = 0

        def rows(pieces: list[tuple], sequences: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
            names, starts, totals, ids = zip(*pieces, strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int64()), pa.array(starts, pa.int64()), pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()), pa.array(totals, pa.int64()),
                    pa.array(base + sequences), pa.array(places, pa.int64()),
                ],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        def close(items: list[tuple]) -> pa.RecordBatch:
            nonlocal used
            item, lengths, placed = windows_for(np.array([len(x[3]) for x in items]), window)
            begin = np.zeros(len(items), np.int64)
            pieces = []
            for i, n in zip(item.tolist(), lengths.tolist(), strict=True):
                name, start, total, ids = items[i]
                a = int(begin[i])
                begin[i] = a + n
                pieces.append((name, start + a, total, ids[a : a + n]))
            order = np.argsort(placed, kind="stable")
            filled = np.cumsum(lengths[order]) - lengths[order]
            first = np.searchsorted(placed[order], placed[order])
            out = rows([pieces[i] for i in order], used + placed[order], filled - filled[first])
            used += int(placed.max()) + 1
            return out

        def cut(amount: int, most: int) -> int:
            """How many waiting pieces make a block."""
            n = 0
            while n < min(most, len(waiting)) and amount > 0:
                amount -= len(waiting[n][3])
                n += 1
            return n

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, text in slices(batch.column(1)):
                flat, counts = words.encode(text)
                ends = np.concatenate([[0], np.cumsum(counts)]).tolist()
                for k in range(len(text)):
                    ids, name = flat[ends[k] : ends[k + 1]], names[first + k]
                    whole = len(ids) // window
                    if whole:
                        pieces = [(name, w * window, len(ids), ids[w * window : (w + 1) * window]) for w in range(whole)]
                        yield rows(pieces, used + np.arange(whole), np.zeros(whole, np.int64))
                        used += whole
                    if rest := len(ids) - whole * window:
                        waiting.append((name, whole * window, len(ids), ids[whole * window :]))
                        held += rest
                    while held > 2 * BLOCK_WINDOWS * window or len(waiting) > 2 * BLOCK_PIECES:
                        n = cut(BLOCK_WINDOWS * window, BLOCK_PIECES)
                        block, waiting = waiting[:n], waiting[n:]
                        held -= sum(len(x[3]) for x in block)
                        yield close(block)
        while waiting:
            n = cut(2 * BLOCK_WINDOWS * window, 2 * BLOCK_PIECES)
            block, waiting = waiting[:n], waiting[n:]
            yield close(block)

    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return docs.select("doc_id", "text").mapInArrow(lambda batches: given_back(work(batches)), schema)


def op6_karmarkar_karp_packing(spark, folder: str) -> DataFrame:
    """Per piece: which ids of which document lie where in which sequence."""
    pieces = pack(table(spark, folder, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
