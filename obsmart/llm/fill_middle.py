"""Fill-in-middle transformation with a Fenwick tree over text blocks.

A text is cut into blocks of ``BLOCK`` bytes. A Fenwick tree over its blocks
stores how many units (lines) end in each and how many code points begin in
it. The cut after unit k is found by binary lifting: the descent takes the
longest run of blocks with fewer than k unit ends and sums its code points on
the way; inside the next block the k-th end is located directly. A cut so
reads one block and as many nodes as the number of blocks has bits, wherever
it lies; the descents of all texts of a batch are made side by side.

Which document is cut where depends on its doc_id and the seed alone, so
every run and every partitioning gives the same result, row by row, without a
shuffle. ``restored`` rebuilds the text from form and output with built-in
functions.

Cases: a null text is an empty one and stays plain with no units; so does a
text that holds a sentinel; a null doc_id draws as the word ``null``; rows that
repeat a doc_id are cut after the same draws, equal rows alike; both cuts may
fall together (an empty middle) or on an end of the text; a very long text is
handled alone, in memory of a few times its size; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.llm.common import given_back, ship_code, slices, table, texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Hundredths of the documents that are transformed, and of these, in suffix-first form.
RATE, SUFFIX_FIRST = 100, 50
#: Bytes of a block.
BLOCK = 2048

_FORMS = pa.array(["plain", "psm", "spm"])


@dataclass
class BlockTrees:
    """The Fenwick trees of many texts that lie end to end in ``data``.

    Node i (from 1) of a text covers the i & -i blocks up to block i. All
    trees share two arrays; a text's nodes begin after ``base``.
    """

    data: np.ndarray
    start: np.ndarray  # first byte of each text, and the end of the last
    base: np.ndarray  # blocks of all earlier texts
    blocks: np.ndarray  # blocks of each text
    ends: np.ndarray  # unit ends by node
    points: np.ndarray  # code points by node
    n_ends: np.ndarray  # unit ends of each text
    n_points: np.ndarray

    @classmethod
    def build(cls, data: np.ndarray, start: np.ndarray, block: int = BLOCK) -> BlockTrees:
        sizes = np.diff(start)
        blocks = -(-sizes // block)
        last = np.cumsum(blocks)
        base = last - blocks
        owner = np.repeat(np.arange(len(sizes)), blocks)
        place = np.arange(len(owner)) - base[owner]
        first = start[:-1][owner] + place * block

        def per_block(mark: np.ndarray) -> np.ndarray:
            if not len(first):
                return np.zeros(1, np.int64)
            whole = mark[: start[-1]].view(np.uint8)
            sums = np.add.reduceat(whole[first[0] :], first - first[0], dtype=np.int64)
            return np.concatenate([[0], np.cumsum(sums)])

        def nodes(sums: np.ndarray) -> np.ndarray:
            node = place + 1
            return sums[base[owner] + node] - sums[base[owner] + node - (node & -node)]

        ends = per_block(data == 10)
        points = per_block((data & 0xC0) != 0x80)
        return cls(data, start, base, blocks, nodes(ends), nodes(points), ends[last] - ends[base], points[last] - points[base])

    def cuts(self, text: np.ndarray, k: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, code points) of the first ``k`` units of each given text;
        k may be one more than the unit ends: the rest after the last end."""
        left, points = k.astype(np.int64).copy(), np.zeros(len(k), np.int64)
        at = np.zeros(len(k), np.int64)  # blocks that lie whole before the cut
        size, base = self.blocks[text], self.base[text]
        step = 1 << max(0, int(size.max(initial=0)).bit_length() - 1)
        while step:
            node = at + step
            open_ = np.flatnonzero(node <= size)
            index = base[open_] + node[open_] - 1
            open_, index = open_[(fits := self.ends[index] < left[open_])], index[fits]
            left[open_] -= self.ends[index]
            points[open_] += self.points[index]
            at[open_] = node[open_]
            step >>= 1
        out = np.minimum(at * block, self.start[1:][text] - self.start[:-1][text])
        # what is left to find lies in the next block; none is, where k is 0 or beyond the last end
        for i in np.flatnonzero((k > 0) & (at < size)).tolist():
            begin = self.start[text[i]] + at[i] * block
            inside = self.data[begin : min(begin + block, self.start[text[i] + 1])]
            cut = int(np.flatnonzero(inside == 10)[left[i] - 1]) + 1
            out[i] += cut
            points[i] += int(((inside[:cut] & 0xC0) != 0x80).sum())
        zero = k == 0
        out[zero], points[zero] = 0, 0
        return out, points


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of seed and decimal id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    digest = F.sha2(name, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _assembled(column: pa.Array, h: np.ndarray, rate: int, suffix_first: int) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of a run of texts."""
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    start = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data, start = data[start[0] : start[-1]], start - start[0]
    trees = BlockTrees.build(data, start)
    sizes = np.diff(start)
    open_end = np.zeros(len(sizes), bool)
    some = sizes > 0
    open_end[some] = data[start[1:][some] - 1] != 10
    n = trees.n_ends + open_end
    spoken = column.cast(pa.large_string())
    held = [pc.match_substring(spoken, mark).to_numpy(zero_copy_only=False) for mark in (PREFIX, SUFFIX, MIDDLE)]
    plain = ~some | np.logical_or.reduce(held) | (h[2] % 100 >= rate)
    form = np.where(plain, 0, np.where(h[3] % 100 < suffix_first, 2, 1))
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    text = np.flatnonzero(~plain)
    one, one_points = trees.cuts(text, np.minimum(a, b)[text])
    two, two_points = trees.cuts(text, np.maximum(a, b)[text])
    raw = data.tobytes()
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    begin, end = start[:-1].tolist(), start[1:].tolist()
    out = [raw[x:y] for x, y in zip(begin, end, strict=True)]
    for i, x, y in zip(text.tolist(), one.tolist(), two.tolist(), strict=True):
        x, y = begin[i] + x, begin[i] + y
        first, middle, last = raw[begin[i] : x], raw[x:y], raw[y : end[i]]
        out[i] = b"".join([p, first, s, last, m, middle] if form[i] == 1 else [s, last, p, first, m, middle])
    chars, inner = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    chars[text], inner[text] = one_points, two_points - one_points
    return [
        pa.array(n, pa.int64()), _FORMS.take(pa.array(form)), pa.array(chars, pa.int64(), mask=plain),
        pa.array(inner, pa.int64(), mask=plain), pa.array(out, pa.large_binary()).cast(pa.large_string()),
    ]


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row."""
    ship_code(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.array([batch.column(2 + i).to_numpy() for i in range(4)])
            for first, part in slices(texts(batch.column(1))):
                last = first + len(part)
                found = _assembled(part, h[:, first:last], rate, suffix_first)
                found[-1] = found[-1].cast(batch.schema.field(1).type)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), *found], names)

    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    rows = docs.select("doc_id", "text", *draws(F.col("doc_id"), seed))
    return rows.mapInArrow(lambda batches: given_back(work(batches)), schema)


def restored(form: Column, output: Column) -> Column:
    """The text that an output of a form was made from. The text holds no
    sentinel, so each is found where it was put, at its first occurrence."""

    def after(mark: str) -> Column:
        return F.substring_index(output, mark, -1)

    def between(first: str, second: str) -> Column:
        return F.substring_index(F.substring_index(output, second, 1), first, -1)

    psm = F.concat(between(PREFIX, SUFFIX), after(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op11_fenwick_fill_middle(spark, folder: str) -> DataFrame:
    """Per document: its form, the sizes of its parts, and digests of the output
    and of the text rebuilt from it."""
    found = transform(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS digest
  FROM documents),
numbers AS (
  SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || digest[1:8] AS BIGINT) AS h1, CAST('0x' || digest[9:16] AS BIGINT) AS h2,
         CAST('0x' || digest[17:24] AS BIGINT) AS h3, CAST('0x' || digest[25:32] AS BIGINT) AS h4
  FROM drawn),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT doc_id, n, form, text, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM cut)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
