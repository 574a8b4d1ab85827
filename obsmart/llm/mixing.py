"""Mixing sources to target weights.

Each source's target is its weighted share of all tokens, but at most
``MOST`` times what it has; what that leaves over goes to the other sources by
weight. A document is then emitted floor(rate) times, plus once more if its
hash, a number in [0, 1), lies below the rate's fraction; rate is the source's
target over its size. Reruns agree, and no document needs another's copy count.

The targets come from one number per source. Filling up is a few sums over
that small table, not a loop over sources.

Cases: null and empty texts have size 0 and are emitted by the same rule; the
null source is a source of its own, last in order; repeated rows draw each for
itself; equal draws mean equal texts; a very long text counts like any other; an empty table gives no rows; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.llm.common import n_words, numbered, stage, table, unit_hash

#: Weights of the sources in order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: A source is used at most so many times.
MOST = 3.0
#: Sources up to which their targets are sent to every task, a few MB.
BROADCAST_SOURCES = 50_000
SEED = "mix-1"


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, weight, target) from (source, size)."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    ordered = numbered(per_source.withColumn("no_source", F.col("source").isNull()), ["no_source", "source"], "mix-sources")
    place = (F.col("row_index") % len(weights) + 1).cast("int")
    known = ordered.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place)).drop("no_source", "row_index")
    whole = known.agg(F.sum("source_size")).first()[0] or 0
    full: Column = F.lit(False)  # sources at their limit
    level = None
    while True:
        free, rest = known.agg(F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, most * F.col("source_size")))).first()
        if not free:
            break
        found = (whole - (rest or 0.0)) / free
        if level is not None and found <= level:
            break
        level = found
        full = F.col("weight") * F.lit(level) > most * F.col("source_size")
    share = F.col("weight") * F.lit(float(level or 0.0))
    return known.withColumn("target", F.least(share, most * F.col("source_size")))


def digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def repeats(docs: DataFrame) -> bool:
    """Whether any two rows have the same id, or none, and the same text."""
    rows = docs.groupBy("doc_id", digest(docs["text"]).alias("_text")).agg(F.count(F.lit(1)).alias("_n"))
    return not rows.where("_n > 1").isEmpty()


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: str = SEED) -> DataFrame:
    """Every row with its size, source_size, target, rate and copies, below
    ``mix``; ``row`` holds the row as it came."""
    sized = docs.select(F.struct("*").alias("row"), n_words(docs["text"]).alias("size"))
    goals = stage(targets(sized.select(F.col("row.source").alias("source"), "size"), weights, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(F.lit(1.0))
    goals = goals.withColumn("rate", rate)
    small = goals.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    found = sized.join(F.broadcast(goals) if small else goals, sized["row.source"].eqNullSafe(goals["source"]))
    number = F.monotonically_increasing_id() if repeats(docs) else F.lit(0)
    drawn = unit_hash(F.lit(seed), F.col("row.doc_id"), digest(F.col("row.text")), number) < F.col("rate") - F.floor("rate")
    copies = F.floor("rate") + F.when(drawn, 1).otherwise(0)
    mix = F.struct("size", "source_size", "target", "rate", copies.cast("long").alias("copies"))
    return found.select("row", mix.alias("mix"))


def emit(planned: DataFrame) -> DataFrame:
    """The mix itself: each row as often as planned."""
    repeated = F.array_repeat(F.lit(0), F.col("mix.copies").cast("int"))
    return planned.select("row", F.explode(repeated)).select("row.*")


def op3_source_mix(spark, folder: str) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return plan(docs).select(
        "row.doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.col("mix.copies")).alias("taken")
    )


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, 3.0 * source_size / weight AS fills_at,
         sum(3.0 * source_size) OVER w AS before, sum(weight) OVER w AS weight_before,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM per_source
  WINDOW w AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tried AS (
  SELECT fills_at, (total - coalesce(before, 0)) / (weights - coalesce(weight_before, 0)) AS level FROM ranked),
levels AS (SELECT arg_min(level, fills_at) AS level FROM tried WHERE fills_at >= level),
goals AS (
  SELECT source, source_size, least(weight * level, 3.0 * source_size) AS target FROM per_source, levels),
rated AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN least(g.target / g.source_size, 3.0) ELSE 1.0 END AS rate,
         CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(s.doc_id AS VARCHAR), 'null') || '|' || s.digest || '|0'), 1, 12) AS BIGINT) / 281474976710656.0 AS draw
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""
