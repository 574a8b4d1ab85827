"""Substring deduplication by compaction of a De Bruijn graph of words.

Every window of ``WINDOW`` words is an edge, from its first words but one to
its last words but one. Edges are never shipped one by one:

1. **Paths.** Each window has an anchor, the smallest hash among its runs of
   ``ANCHOR`` words (the first, of equal ones). Consecutive windows with the
   same anchor form a path, about a dozen edges. Equal windows have equal
   anchors at equal places, so all occurrences of an edge lie in paths of one
   anchor; paths of an anchor that occurs once hold nothing repeated and go.
2. **Compaction.** Paths of the same words become one, with a count and the
   first of its source coordinates (row, word). Where an anchor has one path
   only, the graph does not branch there: all its edges occur as often as the path.
3. **Branches.** Where different paths of an anchor meet, each is opened once, at its
   source coordinate: the words there are read again, their digest must be the
   path's, and its edges are counted, each as often as the path occurs.
4. **Spans.** A compacted path that occurs twice or more is repeated at all its
   source coordinates; an edge of a path that occurs once is repeated where
   another path has it. Adjoining ones make up the spans to remove.

Paths and edges are told apart by 128-bit digests. Counting combines before each
exchange; joins on anchors, paths and edges send keys that hold more than a
thousandth of all rows to every task (a thousand keys at most), so neither a
passage in a third of all texts nor a phrase with a million continuations
ends up in one task. Nothing is gathered but the spans of one row.

Cases: null, empty and blank texts have no words; texts shorter than a window
lose none; a word stands for its bytes, unchanged; repeated rows are each
other's copies and lose all that their windows cover; a text may repeat itself, windows
that overlap included; a very long text is handled in stretches of ``STRETCH``
words; a null doc_id is kept as it is, repeated ones are separate rows; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmart.llm.common import given_back, met, ship_code, slices, stage, table, texts
from obsmart.llm.shingles import spread

WINDOW, ANCHOR = 35, 12
#: Words whose windows are worked out at once.
STRETCH = 1 << 19

#: Odd multipliers (from the golden ratio and the square root of two) and their inverses modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0x6A09E667F3BCC909)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n - 1), modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps)
    return _POWERS[base][:n]


class Words:
    """Words of many texts end to end: which text each belongs to, where each
    text begins, and sums from which any run's digest follows."""

    def __init__(self, column: pa.Array):
        split = pc.ascii_split_whitespace(texts(column))
        bounds = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
        flat = split.flatten()
        text = np.repeat(np.arange(len(column)), np.diff(bounds))
        real = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        if not real.all():  # white space at an end leaves an empty word
            flat, text = flat.filter(pa.array(real)), text[real]
        self.flat, self.text = flat, text
        self.counts = np.bincount(text, minlength=len(column))
        self.begin = np.cumsum(self.counts) - self.counts

    def hash(self) -> None:
        coded = self.flat.dictionary_encode()
        blob = b"".join(xxhash.xxh3_128_digest(w) for w in coded.dictionary.to_pylist())
        both = np.frombuffer(blob, "<u8").reshape(-1, 2)
        word = coded.indices.to_numpy(zero_copy_only=False)
        self.sums = []
        for k, base in enumerate(_BASES):
            parts = both[:, k][word] * _powers(base, len(word)) if len(word) else np.empty(0, np.uint64)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(parts, dtype=np.uint64)]))

    def digests(self, first: np.ndarray, size: np.ndarray | int, k: int) -> np.ndarray:
        """64 bits of the runs of ``size`` words from each of ``first``."""
        inverse = _powers(pow(_BASES[k], -1, 1 << 64), len(self.sums[k]))
        raw = (self.sums[k][first + size] - self.sums[k][first]) * inverse[first]
        return spread(raw ^ np.asarray(size, np.uint64))


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of the smallest, the first of equal ones."""
    place, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        a, b = place[: len(place) - step], place[step:]
        place = np.where(values[b] < values[a], b, a)
        have += step
    return place


def paths_of(words: Words, window: int = WINDOW, anchor: int = ANCHOR, stretch: int = STRETCH) -> Iterator[dict[str, np.ndarray]]:
    """Paths of consecutive windows with one anchor: text, start (a word of the
    text), n (windows), anchor and digests."""
    last = len(words.text) - window + 1
    for begin in range(0, max(0, last), stretch):
        end = min(last, begin + stretch)
        runs = np.arange(begin, end + window - anchor)
        values = words.digests(runs, anchor, 0)
        at = np.arange(begin, end)
        inside = words.text[at] == words.text[at + window - 1]
        at, place = at[inside], smallest(values, window - anchor + 1)[: end - begin][inside]
        if not len(at):
            continue
        new = np.ones(len(at), bool)
        new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
        heads = np.flatnonzero(new)
        first, n = at[heads], np.diff(np.append(heads, len(at)))
        text = words.text[first]
        yield {
            "text": text, "start": first - words.begin[text], "n": n, "anchor": values[place[heads]],
            "h1": words.digests(first, n + window - 1, 0), "h2": words.digests(first, n + window - 1, 1),
        }


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _paths(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, h1, h2, n, row, start) of every path of every text."""
    names = ["anchor", "h1", "h2", "n", "row", "start"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0).to_numpy()
            for begin, part in slices(batch.column(1)):
                words = Words(part)
                words.hash()
                for p in paths_of(words, window, anchor):
                    yield pa.RecordBatch.from_arrays(
                        [_signed(p["anchor"]), _signed(p["h1"]), _signed(p["h2"]), pa.array(p["n"].astype(np.int32)),
                         pa.array(row[begin + p["text"]]), pa.array(p["start"].astype(np.int32))], names,
                    )

    schema = "anchor long, h1 long, h2 long, n int, row long, start int"
    return rows.select("row", "text").mapInArrow(lambda batches: given_back(work(batches)), schema)


class PathDiffers(RuntimeError):
    """A source coordinate does not hold the words of its path."""


def _listed(column: pa.Array, part: slice) -> tuple[np.ndarray, pa.StructArray]:
    """Which of the rows each entry of a column of lists belongs to, and the entries."""
    lists = column.slice(part.start, part.stop - part.start)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten()


def _edges(opened: DataFrame, window: int) -> DataFrame:
    """(e1, e2, c, row, at) for each window of the paths listed with a text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0).to_numpy()
            for begin, part in slices(batch.column(1)):
                words = Words(part)
                words.hash()
                text, entries = _listed(batch.column(2), slice(begin, begin + len(part)))
                start, n, c, h1, h2 = (entries.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "n", "c", "h1", "h2"))
                first = words.begin[text] + start
                for k, want in enumerate((h1, h2)):
                    if (words.digests(first, n + window - 1, k).view(np.int64) != want).any():
                        raise PathDiffers(f"row {row[begin]} or one after it")
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(first, n) + inner
                yield pa.RecordBatch.from_arrays(
                    [_signed(words.digests(at, window, 0)), _signed(words.digests(at, window, 1)), pa.array(np.repeat(c, n)),
                     pa.array(row[begin + np.repeat(text, n)]), pa.array((np.repeat(start, n) + inner).astype(np.int32))],
                    ["e1", "e2", "c", "row", "at"],
                )

    return opened.select("row", "text", "paths").mapInArrow(
        lambda batches: given_back(work(batches)), "e1 long, e2 long, c long, row long, at int"
    )


def spans(rows: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(row, start, n): at ``start`` begin ``n`` repeated windows, one word apart.
    ``rows`` is a stored table (row, text), each row with a number of its own."""
    found = stage(_paths(rows, window, anchor), "spans-paths")
    anchors = stage(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "spans-anchors")
    shared = stage(met(found, anchors, ["anchor"], "times").drop("times"), "spans-shared")
    compact = shared.groupBy("h1", "h2").agg(
        F.first("anchor").alias("anchor"), F.first("n").alias("n"), F.count(F.lit(1)).alias("c"), F.min(F.struct("row", "start")).alias("source")
    )
    compact = stage(compact, "spans-compact")
    variants = compact.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1")
    branching = met(compact, stage(variants, "spans-variants"), ["anchor"], "variants")
    entry = F.struct(F.col("source.start").alias("start"), "n", "c", "h1", "h2")
    opened = branching.groupBy(F.col("source.row").alias("row")).agg(F.collect_list(entry).alias("paths"))  # of one text
    edges = stage(_edges(opened.join(rows, "row"), window), "spans-edges")
    again = edges.groupBy("e1", "e2").agg(F.sum("c").alias("times"), F.count_if(F.col("c") == 1).alias("single"))
    again = stage(again.where("times > 1 AND single > 0").drop("times"), "spans-again")
    crossing = met(edges.where("c = 1"), again, ["e1", "e2"], "single")
    repeated = stage(compact.where("c > 1").select("h1", "h2", "c"), "spans-repeated")
    whole = met(shared, repeated, ["h1", "h2"], "c")
    return whole.select("row", "start", "n").unionByName(crossing.select("row", F.col("at").alias("start"), F.lit(1).alias("n")))


def _without(marked: DataFrame, window: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in slices(batch.column(1)):
                words = Words(part)
                text, entries = _listed(batch.column(2), slice(begin, begin + len(part)))
                edge = np.zeros(len(words.text) + 1, np.int64)
                if len(entries):
                    start, n = (entries.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "n"))
                    first = words.begin[text] + start
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + n + window - 1, -1)
                keep = np.cumsum(edge[:-1]) == 0
                left = np.bincount(words.text[keep], minlength=len(part))
                ends = pa.array(np.concatenate([[0], np.cumsum(left)]), pa.int32())
                kept = pc.binary_join(pa.ListArray.from_arrays(ends, words.flat.filter(pa.array(keep))), pa.scalar(" ", pa.large_string()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(part)), pa.array(words.counts, pa.int64()), pa.array(words.counts - left, pa.int64()),
                     kept.cast(batch.schema.field(1).type)], ["doc_id", "n_words", "n_removed", "kept"],
                )

    return marked.select("doc_id", "text", "spans").mapInArrow(
        lambda batches: given_back(work(batches)), "doc_id long, n_words long, n_removed long, kept string"
    )


def dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of each row; ``kept`` are the words that
    no repeated window covers, joined by one space."""
    ship_code(docs.sparkSession)
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "spans-rows")
    listed = spans(rows.select("row", "text"), window, anchor).groupBy("row").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return _without(rows.join(listed, "row", "left"), window)


def op12_debruijn_dedup(spark, folder: str) -> DataFrame:
    """Per document: its words, how many of them are removed, and a digest of the rest."""
    found = dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
placed AS (SELECT rid, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs),
spelt AS (
  SELECT rid, i, word,
         CASE WHEN i <= n - 34 THEN sha256(string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) END AS w
  FROM placed),
again AS (SELECT rid, i, word, w IS NOT NULL AND count(*) OVER (PARTITION BY w) > 1 AS repeated FROM spelt),
covered AS (
  SELECT rid, i, word, bool_or(repeated) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM again),
kept AS (
  SELECT rid, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS words
  FROM covered GROUP BY rid)
SELECT doc_id, CAST(len(docs.words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.words, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""
