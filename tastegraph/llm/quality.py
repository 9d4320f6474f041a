"""Operator 1: quality rules.

A table of thresholds (metric, lowest, highest) is compiled into one Spark
projection of length, symbol, stop-word and line ratios. Everything is a
built-in column expression: no user functions, no shuffle, no driver data.

Defined results: a null or wordless text has zero counts and fails the base
rule; repeated rows each get their own verdict; columns besides ``doc_id`` and
``text`` are ignored, whatever their names; an empty table gives no rows.
Texts of any length are judged whole (the repeat count sorts a text's windows,
O(n log n)).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.text import count_chars, take_columns, words

# Regular-expression classes and frequent (lower-case) words of four languages.
SYMBOLS = "#*$%&|<>"
SHOUTS = "!?"
CAPITALS = "\\p{Lu}"
LETTERS = "\\p{L}"
STOP_WORDS = (
    "the of and to in is that for it was with as on be at by an or from this are not "
    "le la les de des du et en un une que qui dans pour sur par est pas avec au "
    "der die das und von zu mit den im ist nicht ein eine auf für dem sich als auch "
    "el los las y del se por con para su una no lo al como más"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes when ``lowest <= metric <= highest`` (None: no bound)."""

    metric: str
    lowest: float | None = None
    highest: float | None = None


DEFAULT_RULES = (
    Rule("mean_word_chars", 2.0, 12.0),
    Rule("symbols_per_word", highest=0.1),
    Rule("shouts_per_word", highest=0.3),
    Rule("capital_share", highest=0.4),
    Rule("stop_word_share", lowest=0.01),
    Rule("dup_line_share", highest=0.5),
    Rule("bullet_line_share", highest=0.9),
    Rule("ellipsis_line_share", highest=0.3),
)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _covered_words(starts: Column) -> Column:
    """Words covered by the 3-word windows that begin at the sorted ``starts``."""
    zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        starts,
        zero,
        lambda acc, s: F.struct(
            s.alias("last"), (acc["n"] + F.least(F.lit(3), s - acc["last"])).alias("n")
        ),
        lambda acc: acc["n"],
    )


def text_metrics(documents: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: the base counts and every metric a rule may name."""
    df = take_columns(documents, {id_col: "bigint", text_col: "string"})
    df = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    df = df.withColumn("_w", words(F.col("_t")))
    n = F.size("_w")
    # Distinct window hashes prove that no window repeats; only the other texts are sorted.
    last = F.greatest(n - 2, F.lit(0))
    hashes = F.transform(
        F.slice("_w", 1, last), lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2))
    )
    df = df.withColumn("_same", F.size(F.array_distinct(hashes)) < last)
    # Window keys "w1 w2 w3 position" sort equal windows next to each other.
    keys = F.transform(
        F.slice("_w", 1, F.when(F.col("_same"), last).otherwise(0)),
        lambda w, i: F.concat_ws(
            " ", w, F.get("_w", i + 1), F.get("_w", i + 2), F.lpad(i.cast("string"), 9, "0")
        ),
    )
    has_word = lambda line: line.rlike("[^ \\x09-\\x0D]")
    df = df.withColumn("_keys", F.sort_array(keys)).withColumn(
        "_lines", F.filter(F.split("_t", "\n"), has_word)
    )
    df = df.withColumn("_win", F.transform("_keys", lambda k: F.left(k, F.length(k) - 9)))
    repeated = F.filter(
        "_keys",
        lambda k, j: F.coalesce(F.get("_win", j) == F.get("_win", j - 1), F.lit(False))
        | F.coalesce(F.get("_win", j) == F.get("_win", j + 1), F.lit(False)),
    )
    starts = F.sort_array(F.transform(repeated, lambda k: F.right(k, F.lit(9)).cast("int")))
    n_lines = F.size("_lines").cast("long")
    n_words = n.cast("long")
    stop = F.size(F.filter("_w", lambda w: w.isin(STOP_WORDS)))
    bullet = F.size(F.filter("_lines", lambda s: F.left(F.ltrim(s), F.lit(1)).isin("-", "•", "*")))
    ellipsis = F.size(F.filter("_lines", lambda s: F.rtrim(s).endswith("...") | F.rtrim(s).endswith("…")))
    # The generator keeps filters on the metrics from being rewritten into the expressions above.
    counts = F.struct(
        "doc_id",
        n_words.alias("n_words"),
        F.aggregate("_w", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        count_chars(F.col("_t"), SYMBOLS).alias("n_symbols"),
        (n_lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _covered_words(starts).alias("n_repeat_words"),
        n_lines.alias("n_lines"),
        count_chars(F.col("_t"), SHOUTS).alias("_shouts"),
        count_chars(F.col("_t"), CAPITALS).alias("_capitals"),
        count_chars(F.col("_t"), LETTERS).alias("_letters"),
        stop.alias("_stop"),
        bullet.alias("_bullets"),
        ellipsis.alias("_ellipses"),
    )
    counted = df.select(F.inline(F.array(counts)))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    w, lines = F.col("n_words"), F.col("n_lines")
    return counted.select(
        *base,
        _ratio(F.col("word_chars"), w).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), w).alias("symbols_per_word"),
        _ratio(F.col("_shouts"), w).alias("shouts_per_word"),
        _ratio(F.col("_capitals"), F.col("_letters")).alias("capital_share"),
        _ratio(F.col("_stop"), w).alias("stop_word_share"),
        _ratio(F.col("n_dup_lines"), lines).alias("dup_line_share"),
        _ratio(F.col("_bullets"), lines).alias("bullet_line_share"),
        _ratio(F.col("_ellipses"), lines).alias("ellipsis_line_share"),
    )


def verdict(rules=DEFAULT_RULES) -> Column:
    """The threshold table as one boolean expression over the metric columns."""
    ok = F.lit(True)
    for r in rules:
        if r.lowest is not None:
            ok = ok & (F.col(r.metric) >= F.lit(float(r.lowest)))
        if r.highest is not None:
            ok = ok & (F.col(r.metric) <= F.lit(float(r.highest)))
    return ok


def quality_rules(documents: DataFrame, rules=DEFAULT_RULES, min_words: int = 50) -> DataFrame:
    """Metrics, ``base_failed`` and ``kept`` for every document."""
    m = text_metrics(documents)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return m.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))
