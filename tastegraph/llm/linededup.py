"""Operator 7: line dedup by two-line windows.

Every two adjacent lines are named by a digest, rolled from the digests of the lines, and counted over the
whole table. A line goes if it and a neighbour repeat an earlier pair (smallest doc_id, then first in the
text), once the bytes of both pairs have been compared. Every run of two or more adjacent lines is covered by its
pairs, so a repeated run goes whole, wherever it starts and ends, and no anchors have to be found or extended.
A pair that overlaps its own first place (three equal lines) is no repeat, so the first place of a run of equal lines
stays. Blank lines count as lines; two blank lines are no pair, so blank lines between blank lines stay.

Spark shuffles digests and coordinates of pairs; texts move only for documents with
repeated pairs, and pair texts only for the comparison. A pair with very many
copies is counted by partial aggregation, and its copies meet the one first place in joins that
Spark can split.

Defined results: null and empty texts come back unchanged; a document is known by its doc_id and text: different texts
under one id are judged each on its own (the smaller hash counts as earlier), rows alike in both lose the same lines; rows without an id come after all others and never lose lines; an
empty table gives an empty one; other columns pass through ``dedup_lines`` untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.text import numbered, short_batches, take_columns

SLOTS = 1 << 25  # bits of the bitmap that keeps texts without repeated pairs out of a shuffle


def _pairs(lines: list[str]) -> Iterator[int]:
    """The first line of each pair of adjacent lines that may be removed."""
    blank = [not line or line.isspace() for line in lines]
    for i in range(len(lines) - 1):
        if not (blank[i] and blank[i + 1]):
            yield i


def _digests(lines: list[str]) -> list[bytes]:
    """The digest of each line and the next, rolled from the digests of both."""
    own = [hashlib.blake2b(line.encode(), digest_size=16).digest() for line in lines]
    return [hashlib.blake2b(a + b, digest_size=16).digest() for a, b in zip(own, own[1:])]


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, doc_id, h, no) of pairs of lines."""
    for batch in batches:
        digests, ids, texts, nos = [], [], [], []
        for i, h, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            lines = text.split("\n")
            named = _digests(lines)
            for no in _pairs(lines):
                digests.append(named[no])
                ids.append(i)
                texts.append(h)
                nos.append(no)
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.array(nos, pa.int32())],
            names=["digest", "doc_id", "h", "no"],
        )


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, doc_id, h, no, is_first, body) of the marked pairs of each text."""
    for batch in batches:
        rows = []
        for i, h, text, marks in zip(*(batch.column(k).to_pylist() for k in range(4))):
            lines = text.split("\n")
            for m in marks:
                pair = lines[m["no"] : m["no"] + 2]
                rows.append((_digests(pair)[0], i, h, m["no"], m["is_first"], "\n".join(pair)))
        cols = list(zip(*rows)) if rows else [()] * 6
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)], names=["digest", "doc_id", "h", "no", "is_first", "body"]
        )


def _among(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The (doc_id, h, text) rows whose doc_id is in ``wanted``, and few others: what a bitmap of fixed size lets
    through. The join that follows is exact; the bitmap spares it the shuffle of all other texts."""
    slot = lambda: F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))
    words = wanted.select(slot().alias("s")).groupBy(F.expr("s div 64").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(s % 64 as int)))").alias("bits")
    )  # at most SLOTS / 64 rows
    got, bitmap = words.toPandas(), np.zeros(SLOTS // 64, np.int64)
    bitmap[got["at"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = batch.column(3).to_numpy()
            yield batch.filter(pa.array((shared.value[s >> 6] >> (s & 63)) & 1 == 1)).select([0, 1, 2])

    return docs.withColumn("slot", slot()).mapInArrow(run, docs.schema)


def repeated_chunks(documents: DataFrame) -> DataFrame:
    """(doc_id, h, nos): the first lines of the pairs to remove from each doc_id and text (of hash ``h``), bytes compared."""
    docs = take_columns(short_batches(documents), {"doc_id": "bigint", "text": "string"}).dropna()
    docs = docs.where(F.instr("text", "\n") > 0).select("doc_id", F.xxhash64("text").alias("h"), "text")
    # Read twice rather than kept: a place takes more room than its share of the text is worth.
    places = docs.mapInArrow(_places, "digest binary, doc_id long, h long, no int")
    place = F.struct("doc_id", "h", "no")
    firsts = places.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    firsts = firsts.where(F.col("n") > 1).select("digest", "first")
    after_first = F.struct(F.col("first.doc_id"), F.col("first.h"), (F.col("first.no") + 1).alias("no"))
    marks = places.join(firsts, "digest").where(place != after_first)
    marks = marks.select("doc_id", "h", "no", (place == F.col("first")).alias("is_first"))
    marks = marks.distinct().groupBy("doc_id", "h").agg(F.collect_list(F.struct("no", "is_first")).alias("marks"))
    marks = marks.checkpoint()
    bodies = _among(docs, marks).join(marks, ["doc_id", "h"]).select("doc_id", "h", "text", "marks").mapInArrow(
        _bodies, "digest binary, doc_id long, h long, no int, is_first boolean, body string"
    )
    bodies = bodies.checkpoint()  # both sides of the comparison come from it
    first = bodies.where("is_first").select("digest", F.col("body").alias("first_body")).distinct()
    copies = bodies.where("not is_first").join(first, "digest").where(F.col("body") == F.col("first_body"))
    return copies.select("doc_id", "h", "no").distinct().groupBy("doc_id", "h").agg(F.collect_list("no").alias("nos"))


def without_chunks(text: str, nos: list[int]) -> str:
    """``text`` without both lines of the pairs that start at ``nos``."""
    gone = {*nos, *(no + 1 for no in nos)}
    return "\n".join(line for no, line in enumerate(text.split("\n")) if no not in gone)


def _with_repeats(documents: DataFrame) -> tuple[DataFrame, str]:
    """``documents`` with columns c0, c1, ... and the lines to remove in ``nos`` (null: none); and the column of the text."""
    cols = documents.columns
    key, text = f"c{cols.index('doc_id')}", f"c{cols.index('text')}"
    gone = repeated_chunks(documents).select(F.col("doc_id").alias("gone_id"), F.col("h").alias("gone_h"), "nos")
    same = (F.col(key).cast("bigint") == F.col("gone_id")) & (F.xxhash64(F.col(text).cast("string")) == F.col("gone_h"))
    return numbered(documents).join(gone, same, "left").drop("gone_id", "gone_h"), text


def dedup_lines(documents: DataFrame) -> DataFrame:
    """``documents`` with repeated runs of lines taken out of ``text`` (same columns and rows)."""
    cols = documents.columns
    joined, text = _with_repeats(documents)
    at = int(text[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                t if nos is None or t is None else without_chunks(t, nos)
                for t, nos in zip(batch.column(at).to_pylist(), batch.column(len(cols)).to_pylist())
            ]
            arrays = [batch.column(i) for i in range(len(cols))]
            arrays[at] = pa.array(texts, arrays[at].type)
            yield pa.RecordBatch.from_arrays(arrays, names=cols)

    return joined.mapInArrow(run, documents.schema)


def dedup_documents(documents: DataFrame) -> DataFrame:
    """``dedup_lines`` over the columns of ``documents``, with ``n_chars`` of what is left."""
    out = dedup_lines(documents)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out


def line_report(documents: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256) for every document; null text: 0 lines, null digest.

    What follows a last line break is a line, but when it goes with the text before, it is not counted as removed."""
    docs = take_columns(short_batches(documents), {"doc_id": "bigint", "text": "string"})
    joined, text = _with_repeats(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, nos in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kept = t if t is None else without_chunks(t, nos or [])
                n = 0 if t is None else t.count("\n") + 1
                gone = {*(nos or []), *(no + 1 for no in nos or [])}
                if t and t.endswith("\n"):
                    gone.discard(n - 1)
                rows.append((n, len(gone), kept if kept is None else hashlib.sha256(kept.encode()).hexdigest()))
            cols = list(zip(*rows)) if rows else [()] * 3
            kinds = [pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["doc_id", "n_lines", "n_removed", "kept_sha256"],
            )

    return joined.select("c0", text, "nos").mapInArrow(run, "doc_id long, n_lines long, n_removed long, kept_sha256 string")
