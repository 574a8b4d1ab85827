"""Token ids in wavelet-matrix files.

A shard file holds the ids of consecutive documents as succinct bit-planes.
Plane b keeps bit b of every id, after a stable partition of the ids by the
planes above it; together with the number of zeros of each plane, rank and
select on the planes answer: which id is at a position, how often an id
occurs in a range, where its k-th occurrence is. Nothing else of the ids is kept.

Layout (little-endian): ``WAVM``, format version (u2), planes (u2), ids (u8),
documents (u8), first id's place among all ids of its range partition (u8);
then for the document table and for each plane its compressed length (u4);
for each plane its zeros (u8); then the Zstandard frames themselves. The
document table is three columns: known ids as flags (u1), doc_id (i8), ids (u8).

Cases: a null text is an empty one (the end id alone); a null doc_id sorts
first and stays null; rows that repeat a doc_id are all written, ordered by
length and ids; an empty table gives no file and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmart.llm.common import given_back, offsets, partitions, ship_code, slices, stage
from obsmart.llm.tokens import encoder, tokenizer_path
from obsmart.session import fresh_dir

MAGIC, VERSION = b"WAVM", 1
HEAD = struct.Struct("<4sHHQQQ")
#: Ids after which a shard file is closed; a document is never cut.
SHARD_IDS = 1 << 18


class WaveletMatrix:
    """Rank, select and access over bit-planes."""

    def __init__(self, planes: list[np.ndarray], zeros: list[int], length: int):
        self.planes, self.zeros, self.length = planes, zeros, length
        self._ranks: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros = [], []
        for b in range(bits - 1, -1, -1):
            bit = ((ids >> b) & 1).astype(bool)
            planes.append(np.packbits(bit, bitorder="little"))
            first, second = np.flatnonzero(~bit), np.flatnonzero(bit)
            zeros.append(len(first))
            ids = ids[np.concatenate([first, second])]
        return cls(planes, zeros, len(ids))

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], count=self.length, bitorder="little")

    def _ones(self, level: int) -> np.ndarray:
        """Ones before each position, and in all."""
        if level not in self._ranks:
            self._ranks[level] = np.concatenate([[0], np.cumsum(self._bits(level), dtype=np.int64)])
        return self._ranks[level]

    def all_ids(self) -> np.ndarray:
        """Every id in order: the planes' partitions are undone from the last."""
        out = np.zeros(self.length, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            bit, zeros = self._bits(level).astype(bool), self.zeros[level]
            before = np.empty_like(out)
            before[~bit] = out[:zeros]
            before[bit] = out[zeros:] | (1 << (len(self.planes) - 1 - level))
            out = before
        return out

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.length:
            raise IndexError(at)
        found = 0
        for level, zeros in enumerate(self.zeros):
            ones = self._ones(level)
            bit = int(ones[at + 1] - ones[at])
            found = found << 1 | bit
            at = zeros + int(ones[at]) if bit else at - int(ones[at])
        return found

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int]:
        """Where the occurrences of an id in [begin, end) lie below the last plane."""
        bits = len(self.planes)
        if token >> bits:
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            ones = self._ones(level)
            if token >> (bits - 1 - level) & 1:
                begin, end = zeros + int(ones[begin]), zeros + int(ones[end])
            else:
                begin, end = begin - int(ones[begin]), end - int(ones[end])
        return begin, end

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        """Occurrences of an id in [begin, end)."""
        a, b = self._range(token, begin, self.length if end is None else end)
        return b - a

    def rank(self, token: int, at: int) -> int:
        """Occurrences of an id before a position."""
        return self.count(token, 0, at)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence of an id, from 0; -1 if there are fewer."""
        a, b = self._range(token, 0, self.length)
        if not 0 <= k < b - a:
            return -1
        at = a + k
        for level in range(len(self.planes) - 1, -1, -1):
            ones, zeros = self._ones(level), self.zeros[level]
            if at >= zeros:
                at = int(np.searchsorted(ones, at - zeros + 1)) - 1
            else:
                none = np.arange(len(ones)) - ones
                at = int(np.searchsorted(none, at + 1)) - 1
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]


def to_bytes(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray, start: int, bits: int) -> bytes:
    """One shard file."""
    matrix = WaveletMatrix.build(ids, bits)
    pack = zstandard.ZstdCompressor(level=1).compress
    known = np.array([d is not None for d in doc_ids], np.uint8)
    table = known.tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + lengths.astype("<u8").tobytes()
    frames = [pack(table), *(pack(p.tobytes()) for p in matrix.planes)]
    return b"".join(
        [
            HEAD.pack(MAGIC, VERSION, bits, len(ids), len(doc_ids), start),
            struct.pack(f"<{bits + 1}I", *map(len, frames)),
            struct.pack(f"<{bits}Q", *matrix.zeros),
            *frames,
        ]
    )


def from_bytes(blob: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray, int]:
    """(matrix, doc_ids, ids of each document, start) of a shard file."""
    magic, version, bits, length, docs, start = HEAD.unpack_from(blob)
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError("not a wavelet-matrix file of this version")
    sizes = struct.unpack_from(f"<{bits + 1}I", blob, HEAD.size)
    zeros = struct.unpack_from(f"<{bits}Q", blob, HEAD.size + 4 * (bits + 1))
    at, frames, unpack = HEAD.size + 4 * (bits + 1) + 8 * bits, [], zstandard.ZstdDecompressor().decompress
    for size in sizes:
        frames.append(unpack(blob[at : at + size]))
        at += size
    known = np.frombuffer(frames[0], np.uint8, docs)
    names = np.frombuffer(frames[0], "<i8", docs, docs).tolist()
    lengths = np.frombuffer(frames[0], "<u8", docs, 9 * docs).astype(np.int64)
    planes = [np.frombuffer(f, np.uint8) for f in frames[1:]]
    return WaveletMatrix(planes, list(zeros), length), [n if k else None for n, k in zip(names, known, strict=True)], lengths, start


def _bounds(docs: DataFrame, parts: int) -> list[int]:
    """Doc ids that part the table into about equal ranges: one number a range."""
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0]
    return sorted(set(cuts or []))


def write(docs: DataFrame, folder: str, tokenizer: str | None = None, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode (doc_id, text) and write shard files in ascending doc_id order;
    returns (path, part, part_start, n_ids, n_docs), a row for each file.

    Ids go through one shuffle, two bytes each where the vocabulary allows.
    File names are new in every attempt; only those that the finished stage
    reports are ever read, so a lost or repeated task leaves nothing wrong.
    """
    docs = docs.select("doc_id", "text")
    path, spark = tokenizer or tokenizer_path(), docs.sparkSession
    ship_code(spark)
    bounds = np.array(_bounds(docs, partitions(spark)), np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for batch in batches:
            names = batch.column(0)
            for first, text in slices(batch.column(1)):
                ids, counts = words.encode(text)
                ids = ids.astype("<u2" if words.width == 2 else "<u4")
                some = names.slice(first, len(text))
                part = np.searchsorted(bounds, some.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), "right")
                at = np.concatenate([[0], np.cumsum(counts)]) * words.width
                blobs = pa.Array.from_buffers(pa.large_binary(), len(text), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), some, pa.array(counts), blobs.cast(pa.binary())], ["part", "doc_id", "n", "ids"]
                )

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        store, root = pafs.FileSystem.from_uri(folder)
        bits = max(1, (words.tokenizer.get_vocab_size() - 1).bit_length())
        state = {"part": None, "start": 0, "names": [], "blobs": [], "held": 0}

        def close() -> Iterator[pa.RecordBatch]:
            if not state["names"]:
                return
            blobs = [np.frombuffer(b, "<u2" if words.width == 2 else "<u4") for b in state["blobs"]]
            lengths = np.array([len(b) for b in blobs])
            name = f"{root}/{state['part']:05d}-{uuid.uuid4().hex}.wavm"
            with store.open_output_stream(name) as out:
                out.write(to_bytes(np.concatenate(blobs), state["names"], lengths, state["start"], bits))
            yield pa.RecordBatch.from_pydict(
                {
                    "path": [name], "part": pa.array([state["part"]], pa.int32()), "local_start": [state["start"]],
                    "n_ids": [int(lengths.sum())], "n_docs": [len(lengths)],
                }
            )
            state.update(start=state["start"] + int(lengths.sum()), names=[], blobs=[], held=0)

        for batch in batches:
            for part, name, n, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != state["part"]:
                    yield from close()
                    state.update(part=part, start=0)
                state["names"].append(name)
                state["blobs"].append(blob)
                state["held"] += n
                if state["held"] >= shard_ids:
                    yield from close()
        yield from close()

    coded = docs.mapInArrow(lambda batches: given_back(encode(batches)), "part int, doc_id long, n long, ids binary")
    dealt = coded.repartitionById(max(1, len(bounds) + 1), F.col("part")).sortWithinPartitions("part", "doc_id", "n", "ids")
    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(root)
    files = stage(dealt.mapInArrow(put, "path string, part int, local_start long, n_ids long, n_docs long"), "wavelet-files")
    starts = offsets(files, "part", "n_ids")
    return files.join(F.broadcast(starts), "part")  # a row for each range


def read(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the listed files;
    ids as little-endian unsigned 32-bit integers."""
    n = partitions(files.sparkSession)
    ship_code(files.sparkSession)

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(path) as f:
                    matrix, names, lengths, start = from_bytes(f.read())
                ids = matrix.all_ids().astype("<u4")
                ends = np.concatenate([[0], np.cumsum(lengths)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()), pa.array(base + start + ends[:-1]), pa.array(lengths),
                        pa.array([ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return files.select("path", "part_start").repartition(n).mapInArrow(get, "doc_id long, start long, n_tokens long, ids binary")


def op10_wavelet_matrix(spark, folder: str) -> DataFrame:
    """Per document, from the files: place, length and checksum of its ids."""
    from obsmart.llm.common import table

    files = fresh_dir(spark, "wavelet")
    back = read(write(table(spark, folder, "documents"), files), files)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
