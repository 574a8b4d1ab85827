"""How quality filters interact: one pass over the bytes, then every order.

**Transducer.** A table gives each of the 256 bytes its class (word, capital,
symbol, begin of a code point) and a second one the step that the two-state
machine (between words, inside a word) takes from one byte to the next. One
pass over a run of texts adds up classes and emits word spans where the state
changes. The spans go into a hash table with open addressing: a span that
meets an occupied slot is compared with the occupant byte by byte and, if it
differs, moves on; so distinct words are exact, whatever the hashes do.

**Audit.** What any order of filters does to a document depends only on the set
of filters that it fails. Documents are therefore counted by (part, set of
failed filters), a few rows a part, combined before every exchange. A step of
an order is a filter with the set of those before it: with five filters 80
such steps are worked out once for each part and then laid out as the 120
orders. No row meets another one's row, and no document is seen twice.

The fifth filter (copy of a smaller doc_id) compares SHA-256 digests. Rows are
combined by (digest, doc_id, part, labels) first, so a text that a third of
all rows share is a few numbers by the time its group comes together.

Cases: a null text is empty, a null lang is the part "" (as an empty lang is);
rows without a doc_id are no copies and make none, and have no label; rows
that repeat a doc_id count each, and are no copies of one another; of several
labels of a doc_id the greatest counts, null labels are 0; a text of one very
long word or of many different ones needs memory of some times its size; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsmart.llm.common import given_back, ship_code, slices, table, texts

#: The filters in order: fewer words than, distinct words below hundredths of the
#: words, capitals above hundredths of the code points, any symbol, a copy.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3

# -- the transducer ---------------------------------------------------------------
WORD, CAPITAL, SYMBOL, POINT = 1, 2, 4, 8
BETWEEN, INSIDE = 0, 1


def byte_classes() -> np.ndarray:
    """Class bits of every byte."""
    out = np.full(256, WORD | POINT, np.uint8)
    out[0x80:0xC0] = WORD  # continues a code point
    out[[0x20, *range(0x09, 0x0E)]] = POINT
    out[ord("A") : ord("Z") + 1] |= CAPITAL
    out[list(b"#$%&*|")] |= SYMBOL
    return out


#: Step from state to state by the class bit for words: +1 opens a word, -1 ends one.
STEPS = np.array([[0, 1], [-1, 0]], np.int8)
CLASSES = byte_classes()
NEXT = CLASSES & WORD
_SPREAD = np.uint64(0x9E3779B97F4A7C15)  # odd, from the golden ratio


def scan(data: np.ndarray, start: np.ndarray) -> dict[str, np.ndarray]:
    """Per text: words, capitals, symbols, code points and distinct words."""
    n = len(start) - 1
    classes = CLASSES[data]
    state = NEXT[data]
    before = np.empty(len(state) + 1, np.uint8)  # the state in which each byte is met
    before[1:] = state
    before[start] = BETWEEN  # every text begins between words
    opens = np.flatnonzero(STEPS[before[:-1], state] == 1)
    after = np.empty(len(state), np.uint8)  # the state that each byte is left for
    after[:-1] = state[1:]
    after[start[1:][start[1:] > start[:-1]] - 1] = BETWEEN
    closes = np.flatnonzero(STEPS[state, after] == -1) + 1
    text = np.searchsorted(start, opens, side="right") - 1
    return {
        "words": np.bincount(text, minlength=n),
        "capitals": _counted(data, classes, CAPITAL, start, n),
        "symbols": _counted(data, classes, SYMBOL, start, n),
        "points": _counted(data, classes, POINT, start, n),
        "distinct": np.bincount(text[Spans(data, opens, closes, text).firsts()], minlength=n),
    }


def _counted(data: np.ndarray, classes: np.ndarray, bit: int, start: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    some = start[1:] > start[:-1]
    if some.any():
        out[some] = np.add.reduceat((classes & bit) != 0, start[:-1][some], dtype=np.int64)
    return out


class Spans:
    """Word spans of texts and the hash table over them."""

    def __init__(self, data: np.ndarray, first: np.ndarray, last: np.ndarray, text: np.ndarray):
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        #: Eight bytes from any place on, as one number.
        self.eights = np.ndarray((len(data) + 1,), "<u8", buffer=padded.data, strides=(1,))
        self.first, self.size, self.text = first, last - first, text
        self.head = self._piece(np.arange(len(first)), 0)

    def _piece(self, spans: np.ndarray, at: int) -> np.ndarray:
        """Bytes ``at`` to ``at`` + 8 of each span, zeros behind its end."""
        left = np.clip(self.size[spans] - at, 0, 8).astype(np.uint64)
        found = self.eights[np.minimum(self.first[spans] + at, len(self.eights) - 1)]
        keep = np.where(left >= 8, ~np.uint64(0), (np.uint64(1) << (left * np.uint64(8))) - np.uint64(1))
        return found & keep

    def hashes(self) -> np.ndarray:
        out = (self.head ^ (self.text.astype(np.uint64) << np.uint64(40)) ^ self.size.astype(np.uint64)) * _SPREAD
        at, rest = 8, np.flatnonzero(self.size > 8)
        while len(rest):
            out[rest] = (out[rest] ^ (out[rest] >> np.uint64(29)) ^ self._piece(rest, at)) * _SPREAD
            at += 8
            rest = rest[self.size[rest] > at]
        return out ^ (out >> np.uint64(32))

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans spell the same word of the same text, byte by byte."""
        out = (self.head[a] == self.head[b]) & (self.size[a] == self.size[b]) & (self.text[a] == self.text[b])
        at, rest = 8, np.flatnonzero(out & (self.size[a] > 8))
        while len(rest):
            out[rest] = self._piece(a[rest], at) == self._piece(b[rest], at)
            at += 8
            rest = rest[out[rest] & (self.size[a[rest]] > at)]
        return out

    def firsts(self) -> np.ndarray:
        """One span of each distinct (text, word)."""
        slots = 1 << max(4, int(2 * len(self.first)).bit_length())
        held = np.full(slots, -1, np.int32)
        pending = np.arange(len(self.first), dtype=np.int32)
        slot = (self.hashes() & np.uint64(slots - 1)).astype(np.int32)
        found = []
        while len(pending):
            empty = held[slot] < 0
            held[slot[empty]] = pending[empty]  # of several, one stays
            occupant = held[slot]
            mine = occupant == pending
            found.append(pending[mine])
            open_ = ~mine
            open_[open_] = ~self.same(pending[open_], occupant[open_])
            pending, slot = pending[open_], (slot[open_] + 1) & (slots - 1)
        return np.concatenate(found) if found else np.empty(0, np.int32)


def features(docs: DataFrame, *more: Column | str) -> DataFrame:
    """n_words, n_distinct, n_capitals, n_symbols and n_points of every whole text, after
    the columns ``more``."""
    ship_code(docs.sparkSession)
    kept = docs.select(*more, F.col("text").alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema][:-1]
    names = [f.name for f in kept.schema][:-1]
    counts = {"n_words": "words", "n_distinct": "distinct", "n_capitals": "capitals", "n_symbols": "symbols", "n_points": "points"}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in slices(texts(batch.column(len(names)))):
                data = np.frombuffer(part.buffers()[2] or b"", np.uint8)
                start = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
                found = scan(data[start[0] : start[-1]], start - start[0])
                rest = [batch.column(i).slice(begin, len(part)) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*rest, *(pa.array(found[c], pa.int64()) for c in counts.values())], [*names, *counts])

    schema = ", ".join([*fields, *(f"{n} long" for n in counts)])
    return kept.mapInArrow(lambda batches: given_back(work(batches)), schema)


# -- the audit ----------------------------------------------------------------------
def failed_by_text() -> Column:
    """Bits of the first four filters that a document fails."""
    failing = [
        F.col("n_words") < LEAST_WORDS,
        100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"),
        100 * F.col("n_capitals") > MOST_CAPITALS * F.col("n_points"),
        F.col("n_symbols") > 0,
    ]
    return sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(failing)), F.lit(0)).cast("int")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``good`` and ``toxic`` to rows with a doc_id and a digest. The rows are
    counts of equal documents by then, and each doc_id has at most one label
    row. Rows without a doc_id match nothing; they are dealt by their digest."""
    by_id = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(
        F.coalesce(F.max("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.max("toxic") == 1, F.lit(False)).alias("toxic")
    )
    none = F.lit(b"")
    rows = rows.withColumn("_spread", F.when(F.col("doc_id").isNull(), F.col("digest")).otherwise(none))
    by_id = by_id.withColumn("_none", none)
    found = rows.join(by_id, (F.col("doc_id") == F.col("_id")) & (F.col("_spread") == F.col("_none")), "left")
    return found.drop("_id", "_spread", "_none").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and set of failed filters."""
    part = F.coalesce(F.col("lang"), F.lit("")).alias("part")
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest")
    seen = features(docs, "doc_id", part, digest).withColumn("mask", failed_by_text())
    per_id = seen.groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    counted = labelled(per_id, labels)
    key = ["digest", "part", "mask", "good", "toxic"]
    smallest = F.min("doc_id").alias("first")
    groups = counted.groupBy(*key).agg(
        F.sum("n").alias("n"), smallest, F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("nameless"),
        F.min_by("n", "doc_id").alias("at_first"),
    )
    each = groups.withColumn("least", F.min("first").over(Window.partitionBy("digest")))  # a few rows a digest
    fine = F.coalesce("nameless", F.lit(0)) + F.when(F.col("first") == F.col("least"), F.col("at_first")).otherwise(0)
    copy = 1 << FILTERS.index("E")
    split = F.array(
        F.struct(F.col("mask").alias("mask"), fine.alias("n")),
        F.struct((F.col("mask") + copy).cast("int").alias("mask"), (F.col("n") - fine).alias("n")),
    )
    rows = each.select("part", "good", "toxic", F.inline(split)).where("n > 0")
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def orders(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step, filter's bit, bits of the filters before it)."""
    out = []
    for order in permutations(filters):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << filters.index(name)
            out.append(("".join(order), step, bit, before))
            before |= bit
    return out


def _literal(rows: list[tuple], names: list[str]) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows])


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order and step."""
    bits = [1 << i for i in range(len(filters))]
    steps = [(bit, sum(some)) for bit in bits for k in range(len(bits)) for some in combinations([b for b in bits if b != bit], k)]
    spread = counts.select("*", F.inline(_literal(steps, ["bit", "before"])))
    mask, bit, before = F.col("mask"), F.col("bit"), F.col("before")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0

    def total(condition: Column, what: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(what)).otherwise(0))

    worked = spread.groupBy("part", "bit", "before").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(mask == bit).alias("unique_fails"), total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    layout: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order, step, b, p in orders(filters):
        layout.setdefault((b, p), []).append((order, step))
    places = F.create_map(
        *[x for (b, p), rows in layout.items() for x in (F.lit(b * 64 + p), _literal(rows, ["filter_order", "step"]))]
    )
    measures = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    share = worked.groupBy("part", F.col("bit").alias("_bit")).agg(
        F.sum(F.col("removed") * F.size(places[F.col("bit") * 64 + F.col("before")])).alias("shapley")
    )
    named = worked.join(share.withColumnRenamed("part", "_part"), (F.col("part") == F.col("_part")) & (F.col("bit") == F.col("_bit")))
    return named.select("part", F.inline(places[F.col("bit") * 64 + F.col("before")]), *measures, "shapley").select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), *measures, "shapley"
    )


def op13_transducer_audit(spark, folder: str) -> DataFrame:
    """Per language, order of the five filters and step: what the step does."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return audit(failure_counts(docs, table(spark, folder, "labels").select("doc_id", "quality", "toxic")))


OP13_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
firsts AS (SELECT text, min(doc_id) AS least FROM docs GROUP BY text),
marks AS (
  SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failing AS (
  SELECT part, len(w) < 200 AS A, 100 * len(list_distinct(w)) < 50 * len(w) AS B,
         100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) AS C,
         regexp_matches(text, '[#$%&*|]') AS D, coalesce(words.doc_id > least, false) AS E,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM words JOIN firsts USING (text) LEFT JOIN marks ON words.doc_id = marks.doc_id),
named AS (
  SELECT part, (CASE WHEN A THEN 'A' ELSE '' END) || (CASE WHEN B THEN 'B' ELSE '' END) || (CASE WHEN C THEN 'C' ELSE '' END)
         || (CASE WHEN D THEN 'D' ELSE '' END) || (CASE WHEN E THEN 'E' ELSE '' END) AS fails,
         count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic
  FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
all_orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, filter_order[s] AS f, filter_order[1:s - 1] AS before
  FROM all_orders, range(1, 6) r(s)),
judged AS (
  SELECT part, filter_order, step, f, n, good, toxic, fails = f AS alone, contains(fails, f) AS failed,
         before <> '' AND regexp_matches(fails, '[' || before || '_]') AS gone
  FROM steps, named),
counted AS (
  SELECT part, filter_order, step, f,
         CAST(sum(CASE WHEN NOT failed AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN failed AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN failed AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN alone THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN failed AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN failed AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
