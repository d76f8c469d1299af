"""Quality rules as a short-circuit cascade.

A rule is a condition on a text's words or lines; a document that meets any is rejected. Which
rules go first is decided on a sample: the time each takes there is measured, beyond what a job takes that judges
nothing, and the next rule is always the one that rejects most per second of what the rules before it leave. The
order changes what is computed, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.session import work_scope, work_table

WORD = "[^\\x20\\x09-\\x0D]+"
SYMBOL = "[#*$%&|<>]"
WINDOW = 5
SAMPLE_ROWS = 2000
SAMPLE_PARTS = 4
#: A rule is timed on each row of the sample so many times over, so that it stands out from its job.
TURNS = 8
#: Of what a job takes that judges nothing; less cannot be told from it.
LEAST_COST = 0.01


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.filter(lines, lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))


def windows_of(words: Column) -> Column:
    """Hash of each window of words, in order."""
    window = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW)))
    return F.when(
        F.size(words) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window)
    ).otherwise(F.array().cast("array<bigint>"))


def repeated_words(words: Column) -> Column:
    """Number of words in windows that are found twice or more, the first one included.

    Sorting windows by hash puts equal ones side by side; the places of those, sorted again, are
    merged into covered words. Both steps are skipped for a text without equal windows.
    """

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        equal = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        twice = let(
            placed,
            lambda p: F.filter(p, lambda x, i: equal(x, F.get(p, i + 1)) | (i > 0) & equal(x, F.get(p, i - 1))),
        )
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        return let(
            starts,
            lambda s: F.aggregate(
                F.transform(s, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - at, F.lit(WINDOW)))),
                F.lit(0).cast("long"),
                lambda total, n: total + n,
            ),
        )

    return let(
        windows_of(words),
        lambda hashes: F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            covered(hashes)
        ),
    )


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def symbols(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SYMBOL)), F.lit(0)).cast("long")


def duplicate_lines(lines: Column) -> Column:
    """Number of lines equal to an earlier one."""
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


@dataclass(frozen=True)
class Rule:
    """`fails` gives the condition from the columns text, words, lines, by name."""

    name: str
    fails: Callable[[Column, Column, Column], Column]


BASE_RULES = (
    Rule("too few words", lambda text, words, lines: F.size(words) < 10),
    Rule("repeated words", lambda text, words, lines: 100 * repeated_words(words) > 20 * F.size(words)),
)
#: Limits beyond which running text does not go.
TEXT_RULES = (
    Rule("symbols", lambda text, words, lines: 10 * symbols(text) > F.size(words)),
    Rule("repeated lines", lambda text, words, lines: 10 * duplicate_lines(lines) > 3 * F.size(lines)),
    Rule("long words", lambda text, words, lines: word_chars(words) > 15 * F.size(words)),
    Rule(
        "shouting",
        lambda text, words, lines: 3
        * F.size(F.filter(words, lambda w: (F.upper(w) == w) & (F.lower(w) != w) & (F.char_length(w) > 3)))
        > F.size(words),
    ),
    Rule("exclamations", lambda text, words, lines: 5 * F.regexp_count(text, F.lit("[!?]{2,}")) > F.size(words)),
)
RULES = BASE_RULES + TEXT_RULES


def with_parts(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with its words and lines, under names that cannot clash."""
    return docs.withColumns({"__words": words_of(F.col(text)), "__lines": lines_of(F.col(text))})


def _fails(rule: Rule, words: Column, lines: Column) -> Column:
    return F.coalesce(rule.fails(F.col("text"), words, lines), F.lit(False))


def _seconds(sample: DataFrame, condition: Column) -> float:
    """Time of a job that reads the whole sample and counts where `condition` holds, each row `TURNS` times."""
    reads = F.max(F.size("__words") + F.size("__lines") + F.octet_length("text"))
    # The first job is there to compile.
    for turns in (1, TURNS):
        began = time.perf_counter()
        rows = sample.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.lit(turns))))
        rows.agg(reads, F.count_if(condition)).collect()
    return time.perf_counter() - began


def rule_costs(sample: DataFrame, rules: Sequence[Rule]) -> dict[str, float]:
    """Seconds each rule takes on a sample (text, __words, __lines), without what reading it and running a job take."""
    idle = _seconds(sample, F.lit(False))
    spent = {rule.name: _seconds(sample, _fails(rule, F.col("__words"), F.col("__lines"))) for rule in rules}
    return {name: max(seconds - idle, LEAST_COST * idle) / TURNS for name, seconds in spent.items()}


def greedy_order(rules: Sequence[Rule], costs: dict[str, float], patterns: dict[tuple[str, ...], int]) -> list[Rule]:
    """Rules by rejections per cost among the rows that the rules before leave; `patterns` counts rows by the names of
    the rules they meet. Equal rates: the cheaper rule first, then the one given first."""
    left, rest, ordered = dict(patterns), list(rules), []
    while rest:
        rejected = {rule.name: sum(n for names, n in left.items() if rule.name in names) for rule in rest}
        best = min(rest, key=lambda rule: (-rejected[rule.name] / costs[rule.name], costs[rule.name]))
        rest.remove(best)
        ordered.append(best)
        left = {names: n for names, n in left.items() if best.name not in names}
    return ordered


def order_rules(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in the order that rejects most per second, as measured on a sample of about `sample_rows` rows.

    Only the order of the rules hangs on the sample. What comes to the driver is a count for each combination of
    rules met in it. Null and empty texts are sampled like others; an empty table leaves the rules as given.
    """
    rows = docs.count()
    if not rows:
        return list(rules)
    drawn = docs.select("text").sample(min(1.0, sample_rows / rows), seed=0)
    with work_scope(docs.sparkSession):
        sample = work_table(with_parts(drawn.repartition(SAMPLE_PARTS)), "rule-sample")
        met = [F.when(_fails(rule, F.col("__words"), F.col("__lines")), F.lit(rule.name)) for rule in rules]
        names = F.array_compact(F.array(*met)).alias("names")
        patterns = {tuple(row["names"]): row["n"] for row in sample.groupBy(names).agg(F.count("*").alias("n")).collect()}
        return greedy_order(rules, rule_costs(sample, rules), patterns)


def passes(rules: Sequence[Rule], words: Column, lines: Column) -> Column:
    """Whether no rule is met, trying them in order and stopping at the first that is."""
    chain = F.when(_fails(rules[0], words, lines), F.lit(False))
    for rule in rules[1:]:
        chain = chain.when(_fails(rule, words, lines), F.lit(False))
    return chain.otherwise(F.lit(True))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that meet none of the rules, with their columns as they are.

    A null or empty text has no words, so it is rejected. Rows with equal texts get equal
    verdicts, whatever their ids. An empty table stays empty.
    """
    ordered = order_rules(docs, rules, sample_rows)
    # Bound to names inside the condition: as columns they would be computed again wherever the filter,
    # pushed below them, refers to them.
    text = F.col("text")
    return docs.filter(
        let(words_of(text), lambda words: let(lines_of(text), lambda lines: passes(ordered, words, lines)))
    )


def measure(docs: DataFrame, rules: Sequence[Rule] = TEXT_RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts per document, whether it fails on them (base_failed), and `kept`: whether no rule is met either.

    Needs doc_id and text; the cascade runs only for documents that the counts leave. One row per row of `docs`: a null
    or empty text has no words and fails; rows repeated, and rows with equal texts, get equal counts and verdicts; a very
    long text is counted whole. Other columns of `docs` are left out, so none clashes. An empty table gives none.
    """
    ordered = order_rules(docs, rules, sample_rows)
    words, lines, text = F.col("__words"), F.col("__lines"), F.col("text")
    counted = with_parts(docs.select("doc_id", "text")).withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": word_chars(words),
            "n_symbols": symbols(text),
            "n_dup_lines": duplicate_lines(lines),
            "n_repeat_words": repeated_words(words),
        }
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = counted.withColumn("base_failed", failed)
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(passes(ordered, words, lines))
    return judged.withColumn("kept", kept).drop("text", "__words", "__lines")


def op5_quality(spark, sf_dir):
    return measure(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP5_SQL = r"""
WITH parts AS (
  SELECT doc_id, text,
    CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
numbered AS (SELECT row_number() OVER () AS r, * FROM parts),
windows AS (
  SELECT r, i, list_slice(words, i, i + 4) AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM numbered WHERE len(words) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
repeated AS (
  SELECT r, sum(least(5, coalesce(next - i, 5)))::BIGINT AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM twice) GROUP BY r),
counts AS (
  SELECT doc_id, text, words, lines, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[#*$%&|<>]')) END::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM numbered LEFT JOIN repeated USING (r)),
judged AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * len(lines) OR word_chars > 15 * n_words
    OR 3 * len(list_filter(words, lambda w: upper(w) = w AND lower(w) <> w AND length(w) > 3)) > n_words
    OR 5 * len(regexp_extract_all(coalesce(text, ''), '[!?]{2,}')) > n_words) AS kept
FROM judged
"""
