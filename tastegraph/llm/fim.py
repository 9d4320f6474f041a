"""Operator 12: fill-in-middle transformation with a sparse exception index.

A text is cut at two places into prefix, middle and suffix, which are put together anew, so that a model learns to
write the middle. Cuts are made on the UTF-8 bytes, and texts are never decoded: the *exception index* of a
text records only its multibyte characters, by the byte position of each and the running sum of excess bytes (bytes beyond
the first). A code point's byte is its number plus the excess of the multibyte characters before it, found by
``searchsorted``, and the other way round; in an ASCII text both are the same number.

Units of cuts are ``token`` (blanks and the word after them; blanks at the end are a token of their own) or ``char``
(code points). The draws come from the SHA-256 of ``<seed>:<doc_id>``, so reruns agree and any row can be
transformed on its own. A text that is empty or contains a sentinel stays as it is (form ``plain``), so
every output gives its text back exactly: ``restore`` finds the sentinels, which can occur nowhere else.

Defined results: one row per input row; a null text counts as empty (n 0, plain); a null doc_id is hashed as an empty string;
rows that repeat a doc_id draw alike, each for its own text. prefix_chars and middle_chars are null in plain rows. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.text import short_batches, take_columns

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
FIM_PERCENT = 50  # texts that are transformed
SPM_PERCENT = 80  # of these, texts with the suffix first
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class ExceptionIndex:
    """Multibyte characters of a UTF-8 text: where each starts, and the excess bytes up to and with it."""

    def __init__(self, data: np.ndarray):
        self.starts = np.flatnonzero(data >= 0xC0)  # first bytes of two, three and four
        first = data[self.starts]
        self.excess = np.r_[0, np.cumsum(1 + (first >= 0xE0) + (first >= 0xF0))]
        self.n_chars = len(data) - int(self.excess[-1])

    def chars_before(self, byte: int) -> int:
        """How many code points end at or before ``byte`` (a character's first byte, or the end)."""
        return byte - int(self.excess[np.searchsorted(self.starts, byte)])

    def byte_of(self, char: int) -> int:
        """The first byte of code point number ``char``, or the end for the number after the last."""
        return char + int(self.excess[np.searchsorted(self.starts - self.excess[:-1], char)])


def token_ends(data: np.ndarray) -> np.ndarray:
    """The byte after each token: after words that blanks follow, and the end of the text."""
    blank = BLANK[data]
    return np.r_[np.flatnonzero(~blank[:-1] & blank[1:]) + 1, [len(data)] if len(data) else []].astype(np.int64)


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """h1 to h4: the first four groups of eight digits of the SHA-256."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(h[4 * i : 4 * i + 4], "big") for i in range(4)]


def arrange(doc_id: int | None, text: bytes, unit: str = "token", seed: int = SEED, fim: int = FIM_PERCENT, spm: int = SPM_PERCENT):
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    data = np.frombuffer(text, np.uint8)
    index = ExceptionIndex(data) if unit == "char" else None
    ends = token_ends(data) if index is None else None
    n = len(ends) if index is None else index.n_chars
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= fim or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if index is None:
        index = ExceptionIndex(data)
        a, b = (int(ends[k - 1]) if k else 0 for k in (low, high))
        low, high = index.chars_before(a), index.chars_before(b)
    else:
        a, b = index.byte_of(low), index.byte_of(high)
    if h4 % 100 < spm:
        return n, "spm", low, high - low, b"".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]))
    return n, "psm", low, high - low, b"".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]))


def rebuild(output: bytes, form: str) -> bytes:
    """The text that an output of that form came from."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, rest = output[len(first) :].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    return two + middle + one if form == "spm" else one + middle + two


def fill_in_middle(
    documents: DataFrame, unit: str = "token", seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row."""
    if unit not in ("token", "char"):
        raise ValueError(f"unknown unit {unit!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            rows = [arrange(i, t.as_py() or b"", unit, seed, fim_percent, spm_percent) for i, t in zip(ids, texts)]
            cols = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    docs = take_columns(short_batches(documents), {"doc_id": "bigint", "text": "string"})
    docs = docs.select("doc_id", F.col("text").cast("binary"))
    out = docs.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restore(transformed: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, restored): the text rebuilt from output and form."""
    spec = {"doc_id": "bigint", "n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output": "binary"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, outputs = batch.column(2).to_pylist(), batch.column(5)
            back = [None if o.as_py() is None else rebuild(o.as_py(), f) for f, o in zip(forms, outputs)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(back, pa.binary())], names=[*spec, "restored"])

    rows = take_columns(transformed, spec)
    out = rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary, restored binary")
    return out.withColumns({c: F.col(c).cast("string") for c in ("output", "restored")})


def digests(transformed: DataFrame) -> DataFrame:
    """The transformed rows with SHA-256 digests in place of the output and of the text rebuilt from it."""
    return restore(transformed).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )
