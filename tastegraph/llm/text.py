"""Column expressions and small helpers shared by the text operators.

A *word* is a run of characters outside space and U+0009..U+000D
(``[^\\x20\\x09-\\x0D]+``). In Python the same split is ``bytes.split()`` on the
UTF-8 bytes, whose whitespace set is exactly those six ASCII characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.session import written  # noqa: F401

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(text: Column) -> Column:
    """Array of words of ``text`` (null text: an empty array)."""
    parts = F.split(F.coalesce(text, F.lit("")), "[ \\x09-\\x0D]+")
    return F.filter(parts, lambda w: w != F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words (long), without building their array."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^ \\x09-\\x0D]+")).cast("long")


def count_chars(text: Column, char_class: str) -> Column:
    """How many characters of ``text`` the regular-expression class holds (long)."""
    return F.length(F.regexp_replace(text, f"[^{char_class}]+", "")).cast("long")


def take_columns(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Only the named columns, cast to the given types; other columns never interfere.

    A column that the input lacks comes back as nulls.
    """
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{c}`").cast(t) if c in present else F.lit(None).cast(t)).alias(c)
            for c, t in spec.items()
        ]
    )


def held_out(doc_id: Column) -> Column:
    """The fold that models never learn from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns c0, c1, ... in place of their names, which then clash with nothing."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def short_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, with the session's Arrow batches held to ``rows`` rows: texts are long, and
    JVM and Python each hold a batch a task."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(key))
    if now <= 0 or now > rows:
        conf.set(key, str(rows))
    return df
