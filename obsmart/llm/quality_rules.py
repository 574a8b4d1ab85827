"""Quality rules as a short-circuit cascade.

A rule is a condition that rejects a row. The cascade measures on a sample how
long each rule takes and how many rows it rejects, sorts the rules by
rejections per second, and tests them in that order: a row that one rule
rejects is not tested by the later ones. The order changes the cost and which
rule is named, never who is kept.

Only DataFrame functions are used. Repeated windows are found within a row, on
arrays, so that nothing is shuffled: a text whose window hashes are all
different (most are) has none; the others are settled on the words themselves.

Cases: a null text counts as an empty one and has no words; texts that repeat
are judged alike; an empty table gives no rows, with the rules in their given
order; the row as it came is kept inside a struct, so that no column clashes.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.llm.common import SPACE, WORD, stage, table

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
#: Base limits: words at least; repeated words at most, in hundredths of all.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: The verdict's limits in hundredths: symbols to words, repeated lines to lines
#: with words, capitals to characters of words, exclamation marks to words, at most.
MOST_SYMBOLS, MOST_DUP_LINES, MOST_CAPITALS, MOST_SHOUTS = 30, 30, 50, 50
#: Characters of a word, on average.
SHORTEST_MEAN, LONGEST_MEAN = 2, 20
#: Rows, on average, of the sample on which rules are measured, and runs of each.
SAMPLE_ROWS, SAMPLE_RUNS = 4000, 3
#: How often the sample is gone through in one run, so that rules take longer than a job's start.
SAMPLE_TIMES = 5
#: Tasks that hold the sample, however many the table has: each of the timed jobs has so many.
SAMPLE_TASKS = 8

BLANKS = " \t\n\v\f\r"


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[], Column]


def count_of(pattern: str) -> Column:
    """Characters of the text that a one-character pattern matches."""
    return (F.length("text") - F.length(F.regexp_replace("text", pattern, ""))).cast("long")


def worded_lines() -> Column:
    return F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))


def _twins(ordered: Column, key: str) -> Column:
    """Entries of a sorted array that equal a neighbour."""
    return F.filter(
        ordered,
        lambda x, k: F.coalesce(F.get(ordered, k - 1)[key] == x[key], F.lit(False))
        | F.coalesce(F.get(ordered, k + 1)[key] == x[key], F.lit(False)),
    )


def with_words(docs: DataFrame) -> DataFrame:
    """(row, text, words, n_words) of every row; ``row`` is the row as it came."""
    whole = docs.select(F.struct("*").alias("row"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    inner = F.trim("text", F.lit(BLANKS))
    split = whole.withColumn("words", F.when(inner != "", F.split(inner, SPACE)).otherwise(F.array().cast("array<string>")))
    return split.withColumn("n_words", F.size("words").cast("long"))


def with_repeats(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``n_repeat_words``: how many of ``words`` lie in windows found twice
    or more. Each step is a column of its own, computed once for a row and null
    where it isn't needed."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("words") - window), lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(window)])
    )
    steps = df.withColumn("windows", F.when(F.col("n_words") > window, hashes))
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    steps = steps.withColumn("placed", F.when(twice, F.sort_array(placed)))
    steps = steps.withColumn("same_hash", _twins(F.col("placed"), "h"))
    spelt = F.transform(  # by position: a slice would go through the whole array for each window
        "same_hash",
        lambda x: F.struct(F.concat_ws(" ", *[F.get("words", x["i"] + k) for k in range(window)]).alias("w"), x["i"].alias("i")),
    )
    steps = steps.withColumn("spelt", F.sort_array(spelt))
    steps = steps.withColumn("starts", F.sort_array(F.transform(_twins(F.col("spelt"), "w"), lambda x: x["i"])))
    gained = F.transform("starts", lambda s, k: F.least(F.lit(window), F.coalesce(F.get("starts", k + 1) - s, F.lit(window))))
    covered = F.aggregate(gained, F.lit(0).cast("long"), lambda a, b: a + b)
    found = steps.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    return found.drop("windows", "placed", "same_hash", "spelt", "starts")


def base(docs: DataFrame) -> DataFrame:
    """Add the base counts and ``base_failed`` to (row, text, words, n_words)."""
    counted = (
        with_repeats(with_words(docs))
        .withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
        .withColumn("n_symbols", count_of(SYMBOLS))
        .withColumn("distinct_lines", F.array_distinct(worded_lines()))
        .withColumn("n_lines", F.size(worded_lines()).cast("long"))
        .withColumn("n_dup_lines", F.col("n_lines") - F.size("distinct_lines"))
        .drop("distinct_lines", "words")
    )
    few = F.col("n_words") < LEAST_WORDS
    failed = few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    # A condition on the verdict must not be pushed through the counts: it would hold
    # a copy of every step. A row number, which no filter may pass, keeps it above.
    return counted.withColumn("base_failed", F.when(F.monotonically_increasing_id() >= 0, failed))


#: The verdict's rules, on the base counts and the text.
RULES = (
    Rule("symbols", lambda: 100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("n_words")),
    Rule("repeated lines", lambda: 100 * F.col("n_dup_lines") > MOST_DUP_LINES * F.col("n_lines")),
    Rule("capitals", lambda: 100 * count_of(r"\p{Lu}") > MOST_CAPITALS * F.col("word_chars")),
    Rule("shouting", lambda: 100 * count_of("!") > MOST_SHOUTS * F.col("n_words")),
    Rule(
        "word length",
        lambda: (F.col("word_chars") < SHORTEST_MEAN * F.col("n_words")) | (F.col("word_chars") > LONGEST_MEAN * F.col("n_words")),
    ),
)


def measured(docs: DataFrame, rules: tuple[Rule, ...], rows: int = SAMPLE_ROWS, runs: int = SAMPLE_RUNS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) on the rows of a random sample that pass the
    base limits, which are those that the cascade tests; the fastest of a few
    runs over the sample, repeated in memory, counts, less the time of a scan."""
    total = docs.count()
    few = docs.select("text").sample(min(1.0, rows / max(1, total)), seed=7).repartition(SAMPLE_TASKS)
    passing = base(few).where(~F.col("base_failed")).drop("row")
    sample = stage(passing, "quality-sample").withColumn("again", F.explode(F.array_repeat(F.lit(0), SAMPLE_TIMES)))

    def seconds(agg: Column) -> tuple[float, int]:
        best, found = float("inf"), 0
        for _ in range(runs):
            begin = time.perf_counter()
            found = sample.agg(agg).first()[0] or 0
            best = min(best, time.perf_counter() - begin)
        return best, found

    scan, n = seconds(F.count(F.col("text")))
    out = []
    for rule in rules:
        took, rejected = seconds(F.count_if(rule.rejects() & F.col("text").isNotNull()))
        out.append((rule, max(took - scan, 1e-3), rejected / max(1, n)))
    return out


def ordered(found: list[tuple[Rule, float, float]]) -> list[Rule]:
    """Rules by rejections per second, the most first; ties, and rules that reject
    nothing, as given."""
    return [rule for rule, _, _ in sorted(found, key=lambda x: -x[2] / x[1])]


def cascade(df: DataFrame, rules: list[Rule], done: Column | None = None) -> DataFrame:
    """Add ``failed_rule``: the first rule that rejects the row, else null; rows
    that are already ``done`` are not tested."""
    named = F.when(F.lit(False) if done is None else done, F.lit(None).cast("string"))
    for rule in rules:
        named = named.when(rule.rejects(), F.lit(rule.name))
    return df.withColumn("failed_rule", named)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(row, counts, base_failed, failed_rule, kept) of every row."""
    order = ordered(measured(docs, rules))
    verdict = cascade(base(docs), order, F.col("base_failed"))
    return verdict.withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull()).drop("text")


def kept(docs: DataFrame) -> DataFrame:
    """The rows that no rule rejects, with their own columns."""
    return judged(docs).where("kept").select("row.*")


def op1_quality_cascade(spark, folder: str) -> DataFrame:
    """Per document: base counts and verdicts."""
    found = judged(table(spark, folder, "documents").select("doc_id", "text"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("row.doc_id", *counts, "base_failed", "kept")


OP1_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
windows AS (
  SELECT rid, unnest(range(1, len(words) - 3)) AS i, words FROM split WHERE len(words) >= 5),
spelt AS (SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS w FROM windows),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM spelt),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(5) r(k) WHERE n > 1 GROUP BY rid),
counted AS (
  SELECT doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS capitals,
         length(text) - length(replace(text, '!', '')) AS shouts
  FROM split LEFT JOIN covered USING (rid)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 30 * n_lines OR 100 * capitals > 50 * word_chars
            OR 100 * shouts > 50 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM failed
"""
