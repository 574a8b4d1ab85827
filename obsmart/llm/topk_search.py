"""Exact top-k search by a Voronoi join.

Pivots part the vectors into cells. From the cells' summaries (members, largest
distance to the pivot, and scores of the pivots themselves, which are data) each
group of queries gets a lower bound on its k-th best score, and each vector an
upper bound on its score with any query of the group:

    q.x <= c.x + r |x|      for |q - c| <= r, c the group's pivot.

Whole cells are ruled out by their summary, single vectors by their own
bound; only the others are replicated to the group and scored there, chunk by
chunk, and the chunks' best are merged. Bounds are rounded towards keeping
a vector, scores are exact integers, so nothing is lost; how much is ruled
out depends on how well the vectors cluster.

Cases: vectors that are null, empty, or hold null or non-finite components take
no part, nor do rows without an id; pairs with a vector that has a component
beyond 2**26 after scaling are scored apart, in integers of any size; a score
that a long cannot hold counts as the largest or smallest one; equal scores are ranked by id; a
shorter vector counts as continued by zeros, a very long one is a row like any other; rows that repeat an id are one candidate with
the best of their scores, and as a query the greatest of their vectors; other
columns are ignored; fewer than k candidates give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsmart.llm.common import ship_code, stage, table

SCALE, EVERY, BEST = 256, 50, 5
#: Queries of a group on average; groups (and pivots) at most, so that what is
#: broadcast stays within some MB.
GROUP_QUERIES, MOST_PIVOTS = 1024, 2048
#: Vectors of a chunk.
CHUNK = 1 << 15
#: Largest component, and most components, of vectors that are kept in 32 bits and
#: multiplied in 64; all others are wide.
NARROW, LONG_VECTOR = 2.0**26, 1024
#: Rows on a side where pairs with wide vectors are scored; the largest score.
BEYOND, LONGEST = 1 << 11, (1 << 63) - 1
#: Data vectors whose scores bound each query's k-th best from below.
LANDMARKS = 512


def above(x: np.ndarray) -> np.ndarray:
    """A little more than ``x``, whatever its sign: rounding must rule nothing out."""
    return x + 1e-9 * np.abs(x) + 1e-6


@dataclass
class Groups:
    """Pivots with, for each, its group's radius and score bound and its cell's
    radius and longest vector; ``bound`` is infinite where a group has no queries."""

    pivots: np.ndarray
    radius: np.ndarray
    bound: np.ndarray
    cell_radius: np.ndarray

    def wanted(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(group, which of the vectors it may need)."""
        lengths = np.sqrt((x * x).sum(axis=1))
        cells = nearest(x, self.pivots)[0]
        norms = np.sqrt((self.pivots * self.pivots).sum(axis=1))
        among = self.pivots @ self.pivots.T
        for g in np.flatnonzero(np.isfinite(self.bound)).tolist():
            # c.x <= c.p + |c| s and |x| <= |p| + s for x within s of its pivot p
            reach = among[g] + norms[g] * self.cell_radius + self.radius[g] * (norms + self.cell_radius)
            open_ = (above(reach) >= self.bound[g])[cells]
            some = np.flatnonzero(open_)
            if len(some):
                upper = x[some] @ self.pivots[g] + self.radius[g] * lengths[some]
                some = some[above(upper) >= self.bound[g]]
            if len(some):
                yield g, some


def nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each vector and the distance to it."""
    cell, gap = np.zeros(len(x), np.int64), np.zeros(len(x))
    norms = (pivots * pivots).sum(axis=1)
    for at in range(0, len(x), 4096):
        part = x[at : at + 4096]
        squares = (part * part).sum(axis=1)[:, None] + norms - 2 * (part @ pivots.T)
        cell[at : at + 4096] = squares.argmin(axis=1)
        gap[at : at + 4096] = np.sqrt(np.maximum(0, squares.min(axis=1)))
    return cell, gap


def vectors(column: pa.Array, width: int) -> np.ndarray:
    """Stored vectors as rows of doubles, continued by zeros."""
    out = np.zeros((len(column), width))
    for k, blob in enumerate(column.to_pylist()):
        row = np.frombuffer(blob, "<i4")
        out[k, : len(row)] = row
    return out


def scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Integer inner products; through doubles where these are exact."""
    if float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * queries.shape[1] < 2.0**52:
        return np.rint(queries @ data.T).astype(np.int64)
    return queries.astype(np.int64) @ data.astype(np.int64).T


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, width, vector) of the rows that take part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, widths, blobs, wide = [], [], [], []
            rows = batch.column(1).cast(pa.large_list(pa.float64()))
            bounds = rows.offsets.to_numpy()
            values = rows.flatten() if not rows.null_count else rows.values.slice(bounds[0], bounds[-1] - bounds[0])
            values = values.to_numpy(zero_copy_only=False)  # nulls become NaN
            if values.dtype != np.float64:
                values = values.astype(np.float64)
            with np.errstate(invalid="ignore", over="ignore"):
                found = np.floor(scale * values)
                fine = np.abs(found) <= NARROW  # false for NaN
                small = np.abs(found) <= NARROW / 64
                finite = np.isfinite(values)
            lengths = np.where(rows.is_valid().to_numpy(zero_copy_only=False), np.diff(bounds), 0)
            at = 0
            for vec_id, n in zip(batch.column(0).to_pylist(), lengths.tolist(), strict=True):
                if n and vec_id is not None and finite[at : at + n].all():
                    ids.append(vec_id)
                    widths.append(n)
                    wide.append(not (fine if n <= LONG_VECTOR else small)[at : at + n].all())
                    blobs.append((values[at : at + n].astype("<f8") if wide[-1] else found[at : at + n].astype("<i4")).tobytes())
                at += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(widths, pa.int32()), pa.array(blobs, pa.binary()), pa.array(wide, pa.bool_())],
                ["vec_id", "width", "vector", "wide"],
            )

    return embeddings.select("vec_id", "embedding").mapInArrow(work, "vec_id long, width int, vector binary, wide boolean")


def exact(blob: bytes, wide: bool, scale: int) -> list[int]:
    """The scaled components as integers of any size."""
    if not wide:
        return np.frombuffer(blob, "<i4").tolist()
    return [math.floor(Fraction(x) * scale) for x in np.frombuffer(blob, "<f8").tolist()]


def _beyond(data: DataFrame, queries: DataFrame, n_queries: int, k: int, scale: int) -> DataFrame | None:
    """(query_id, vec_id, score) of the k best of all pairs with a wide vector on
    either side, block by block in integers of any size; None where there is no
    such vector. No bound is worked out for these: their squares may be infinite."""
    n_wide, total = data.where("wide").count(), data.count()
    if not n_wide:
        return None

    def solve(name, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = right.to_pylist()
        known = [exact(r["vector"], r["wide"], scale) for r in rows]
        out: list[tuple[int, int, int]] = []
        for q in left.to_pylist():
            own = exact(q["vector"], q["wide"], scale)
            found = [
                (max(-LONGEST, min(LONGEST, sum(a * b for a, b in zip(own, x, strict=False)))), r["vec_id"])
                for r, x in zip(rows, known, strict=True)
                if r["vec_id"] != q["vec_id"] and (q["wide"] or r["wide"])
            ]
            best = dict(sorted(((i, s) for s, i in found), key=lambda x: x[1]))  # of rows that repeat an id, the best
            out += [(q["vec_id"], i, s) for i, s in heapq.nsmallest(k, best.items(), key=lambda x: (-x[1], x[0]))]
        columns = list(zip(*out, strict=True)) or [[]] * 3
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    def grid(asked: DataFrame, held: DataFrame, n_asked: int, n_held: int) -> DataFrame:
        blocks, chunks = (max(1, -(-n // BEYOND)) for n in (n_asked, n_held))
        block, chunk = (F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int") for n in (blocks, chunks))
        left = asked.withColumn("block", block).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        right = held.withColumn("chunk", chunk).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        keys = ["block", "chunk"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(solve, "query_id long, vec_id long, score long")

    queries, data = queries.select("vec_id", "vector", "wide"), data.select("vec_id", "vector", "wide")
    found = grid(queries, data.where("wide"), n_queries, n_wide)
    return found.union(grid(queries.where("wide"), data.where("not wide"), n_wide, total - n_wide))


def _cells(data: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """(cell, n, radius) from each task: a row a cell."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, radius = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
        for batch in batches:
            cell, gap = nearest(vectors(batch.column(0), width), pivots)
            count += np.bincount(cell, minlength=len(pivots))
            np.maximum.at(radius, cell, gap)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]), pa.array(radius[some])], ["cell", "n", "radius"])

    return data.select("vector").mapInArrow(work, "cell int, n long, radius double")


def _query_bounds(queries: DataFrame, pivots: np.ndarray, marks: np.ndarray, mark_ids: np.ndarray, width: int, k: int) -> DataFrame:
    """(grp, radius, bound) from each task: how far its queries are from their
    pivot, and the least of their k-th best landmark scores."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radius, bound = np.full(len(pivots), -1.0), np.full(len(pivots), np.inf)
        for batch in batches:
            x = vectors(batch.column(1), width)
            cell, gap = nearest(x, pivots)
            np.maximum.at(radius, cell, gap)
            known = np.full(len(x), -np.inf)
            if len(marks) > k:
                found = x @ marks.T
                found[batch.column(0).to_numpy()[:, None] == mark_ids] = -np.inf
                known = np.sort(found, axis=1)[:, -k]
            np.minimum.at(bound, cell, known)
        some = np.flatnonzero(radius >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(radius[some]), pa.array(bound[some])], ["grp", "radius", "bound"])

    return queries.select("vec_id", "vector").mapInArrow(work, "grp int, radius double, bound double")


def _some(data: DataFrame, n: int) -> list:
    """``n`` vectors of different ids, the same in every run: those with the smallest hashes."""
    named = data.groupBy("vec_id").agg(F.max("vector").alias("vector"))
    return named.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).collect()


def top_k(embeddings: DataFrame, is_query, k: int = BEST, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other vectors of each query."""
    spark = embeddings.sparkSession
    ship_code(spark)
    data = stage(quantised(embeddings, scale), "search-vectors")
    total, width = data.agg(F.count(F.lit(1)), F.max("width")).first()
    asked = data.where(is_query).groupBy("vec_id").agg(F.max(F.struct("wide", "vector")).alias("v"))
    asked = stage(asked.select("vec_id", "v.vector", "v.wide"), "search-queries")
    beyond = _beyond(data, asked, asked.count(), k, scale)
    queries, data = asked.where("not wide").drop("wide"), data.where("not wide")
    width = data.agg(F.max("width")).first()[0]
    n_queries = queries.count()
    width = width or 1
    n_pivots = max(1, min(MOST_PIVOTS, -(-n_queries // GROUP_QUERIES)))
    marks = _some(data, max(n_pivots, LANDMARKS))  # bounded by LANDMARKS and MOST_PIVOTS
    mark_ids = np.array([r.vec_id for r in marks], np.int64)
    marks = vectors(pa.array([r.vector for r in marks], pa.binary()), width)
    pivots = marks[:n_pivots] if len(marks) else np.zeros((1, width))
    cell_radius = np.zeros(len(pivots))
    for r in _cells(data, pivots, width).groupBy("cell").agg(F.max("radius").alias("radius")).collect():  # a row a pivot
        cell_radius[r.cell] = r.radius
    radius, bound = np.zeros(len(pivots)), np.full(len(pivots), np.inf)
    found = _query_bounds(queries, pivots, marks, mark_ids, width, k).groupBy("grp").agg(F.max("radius").alias("radius"), F.min("bound").alias("bound"))
    for r in found.collect():  # a row a pivot
        radius[r.grp], bound[r.grp] = r.radius, max(r.bound, -1e300)
    shared = spark.sparkContext.broadcast(Groups(pivots, radius, bound, cell_radius))
    chunks = max(1, -(-total // CHUNK))
    blocks = max(1, -(-n_queries // (len(pivots) * 4 * GROUP_QUERIES)))  # a group may hold most queries

    def spread_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, _ = nearest(vectors(batch.column(1), width), shared.value.pivots)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *batch.columns], ["grp", "vec_id", "vector"])

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, some in shared.value.wanted(vectors(batch.column(1), width)):
                take = pa.array(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), g, np.int32)), batch.column(0).take(take), batch.column(1).take(take)], ["grp", "vec_id", "vector"]
                )

    def solve(name, left: pa.Table, right: pa.Table) -> pa.Table:
        q, x = left.combine_chunks(), right.combine_chunks()
        out = {"query_id": [], "vec_id": [], "score": []}
        if q.num_rows and x.num_rows:
            q_ids, x_ids = q["vec_id"].to_numpy(), x["vec_id"].to_numpy()
            order = np.argsort(x_ids, kind="stable")
            x_ids, data_ = x_ids[order], vectors(x["vector"], width)[order]
            rows = vectors(q["vector"], width)
            again = len(np.unique(x_ids)) < len(x_ids)
            for at in range(0, len(rows), 64):
                found = scores(rows[at : at + 64], data_)
                for i, line in enumerate(found):
                    query = q_ids[at + i]
                    most = 2 * k + 1 if not again else len(line)
                    if most < len(line):
                        # candidates down to the most-th best score, ties included
                        floor = np.partition(line, -most)[-most]
                        near = np.flatnonzero(line >= floor)
                    else:
                        near = np.arange(len(line))
                    near = near[x_ids[near] != query]
                    near = near[np.lexsort((x_ids[near], -line[near]))]
                    if again:
                        _, first = np.unique(x_ids[near], return_index=True)
                        near = near[np.sort(first)]
                    near = near[:k]
                    out["query_id"] += [int(query)] * len(near)
                    out["vec_id"] += x_ids[near].tolist()
                    out["score"] += line[near].tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    chunk = F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int")
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    schema = "grp int, vec_id long, vector binary"
    sent = queries.mapInArrow(spread_queries, schema).withColumn("block", block)
    sent = sent.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    copies = data.select("vec_id", "vector").mapInArrow(replicate, schema).withColumn("chunk", chunk)
    copies = copies.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["grp", "block", "chunk"]
    near = sent.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(solve, "query_id long, vec_id long, score long")
    near = near if beyond is None else near.union(beyond)
    merged = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_voronoi_top_k(spark, folder: str) -> DataFrame:
    """The five best other vectors of every fiftieth."""
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % EVERY == 0)


OP2_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i])) AS BIGINT) AS score
  FROM vectors q JOIN vectors x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
