"""Scalar Column -> Column functions (all built-in expressions, no Python UDFs).

Every function here stays inside whole-stage codegen: the reference's row
closures (similarity, cosine, month conversion, message parsing) become plain
Catalyst expressions so the optimizer sees the whole plan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's for right results.
RATING_LOG_TOKEN = "PRODUCT_RATING_PREFIX"  # log marker; a colon follows it
RATING_LOG_MARKER = RATING_LOG_TOKEN + ":"
MESSAGE_SEPARATOR = "|"  # userId|productId|score|timestamp
QUEUE_ITEM_SEPARATOR = ":"  # productId:score
TAG_SEPARATOR = "|"
PRODUCT_FILE_SEPARATOR = "^"
RATING_FILE_SEPARATOR = ","
HIGH_SCORE_CUT = 3.0  # a recent rating scores "high" only when strictly above this
MS_TIMESTAMP_FLOOR = 100_000_000_000  # above this an epoch value is in milliseconds

_SECONDS_PER_DAY = 86400
_JAVA_WS = r"[\x00-\x20]"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1 ---------------------------------------------------------------------------
def yearmonth(epoch_seconds: Column | str) -> Column:
    """Epoch seconds -> yyyyMM as int, in UTC, independent of the session zone."""
    day = F.date_from_unix_date(F.floor(col_(epoch_seconds) / _SECONDS_PER_DAY).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


def epoch_seconds(ts: Column | str, dtype: T.DataType | None = None) -> Column:
    """Timestamp -> epoch seconds (bigint).

    ``timestamp_ntz`` values are wall-clock UTC (the driver tables arrive so), so
    they are converted without consulting the session zone.
    """
    c = col_(ts)
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(c)
    return (
        F.unix_date(F.to_date(c)).cast("long") * _SECONDS_PER_DAY
        + F.hour(c) * 3600
        + F.minute(c) * 60
        + F.floor(F.second(c))
    ).cast("long")


def round6(x: Column | str) -> Column:
    """Round to 6 places with the same IEEE arithmetic in any engine.

    ``floor(x * 1e6 + 0.5 + 1e-6) / 1e6``: decimal midpoints (frequent when
    scores and similarities carry few digits) round up deterministically, and
    last-bit noise from summation order cannot flip the result.
    """
    return F.floor(col_(x) * 1e6 + 0.5 + 1e-6) / 1e6


# F2 ---------------------------------------------------------------------------
def cooccurrence_sim(cocount: Column | str, count1: Column | str, count2: Column | str) -> Column:
    """co / sqrt(n1 * n2); counts are >= 1 so there is no zero division."""
    return col_(cocount) / F.sqrt(col_(count1).cast("double") * col_(count2).cast("double"))


# F3 ---------------------------------------------------------------------------
def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product of two equal-length numeric arrays."""
    return F.aggregate(
        F.zip_with(col_(a), col_(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def l2norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def normalized(a: Column | str) -> Column:
    """Array scaled to unit length (callers drop zero norms first, D4)."""
    n = l2norm(a)
    return F.transform(col_(a), lambda x: x.cast("double") / n)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two dense arrays; null (not NaN) when either norm is zero."""
    denom = l2norm(a) * l2norm(b)
    return F.when(denom > 0, dot(a, b) / denom)


# F4 ---------------------------------------------------------------------------
def log10_floor1(n: Column | str) -> Column:
    """log10(max(n, 1)): the reference defaults a missing counter to 1."""
    return F.log10(F.greatest(col_(n).cast("double"), F.lit(1.0)))


# F5 ---------------------------------------------------------------------------
def tags_to_text(tags: Column | str) -> Column:
    return F.translate(col_(tags), TAG_SEPARATOR, " ")


def tag_terms(tags: Column | str) -> Column:
    """Lower-cased whitespace tokens of the tag text, empty tokens removed."""
    words = F.split(F.lower(tags_to_text(tags)), r"\s+")
    return F.filter(words, lambda w: w != "")


# F6 ---------------------------------------------------------------------------
def java_trim(s: Column | str) -> Column:
    """Strip code points <= U+0020 at both ends (Java ``String.trim``)."""
    return F.regexp_replace(col_(s), f"^{_JAVA_WS}+|{_JAVA_WS}+$", "")


def split_literal(s: Column | str, sep: str) -> Column:
    return F.split(col_(s), re.escape(sep))


def field(parts: Column, i: int) -> Column:
    """0-based element, null when the row is too short (no index error)."""
    return F.get(parts, i)


# F7 ---------------------------------------------------------------------------
def text_after(s: Column | str, marker: str = RATING_LOG_MARKER) -> Column:
    """Piece between the first and second marker, trimmed; null if empty or absent."""
    piece = F.get(split_literal(s, marker), 1)
    return F.nullif(java_trim(piece), F.lit(""))


# F8 ---------------------------------------------------------------------------
def half_star(raw: Column | str) -> Column:
    """UI sends 1..10; stored score is raw/2 rounded half up to 2 places."""
    return F.round(col_(raw).cast("double") / 2, 2)


# F9 ---------------------------------------------------------------------------
def seconds(ts: Column | str) -> Column:
    """Normalise an epoch value that may be in milliseconds to seconds."""
    c = col_(ts).cast("long")
    return F.when(c > MS_TIMESTAMP_FLOOR, F.floor(c / 1000)).otherwise(c).cast("long")


# F10 --------------------------------------------------------------------------
def recs_to_map(recs: Column | str) -> Column:
    return F.map_from_entries(col_(recs))


# F11 --------------------------------------------------------------------------
def encode_queue_item(product_id: Column | str, score: Column | str) -> Column:
    return F.concat_ws(QUEUE_ITEM_SEPARATOR, col_(product_id).cast("string"), col_(score).cast("string"))


def decode_queue_item(item: Column | str) -> Column:
    parts = split_literal(item, QUEUE_ITEM_SEPARATOR)
    return F.struct(
        java_trim(field(parts, 0)).try_cast("int").alias("productId"),
        java_trim(field(parts, 1)).try_cast("double").alias("score"),
    )


# F12 --------------------------------------------------------------------------
def java_string_hash(s: Column | str) -> Column:
    """32-bit ``String.hashCode`` over UTF-16 code units: h = 31*h + unit, wrapped."""
    units = F.regexp_extract_all(F.hex(F.encode(col_(s), "UTF-16BE")), F.lit("([0-9A-F]{4})"), 1)
    acc = F.aggregate(
        units,
        F.lit(0).cast("long"),
        lambda h, u: F.pmod(h * 31 + F.conv(u, 16, 10).cast("long"), F.lit(4294967296)),
    )
    return F.when(acc >= 2147483648, acc - 4294967296).otherwise(acc).cast("int")


# term hashing (M6) --------------------------------------------------------------
# Fixed values of the 32-bit MurmurHash3 for x86, and the seed that MLlib's HashingTF uses.
MURMUR_C1, MURMUR_C2, MURMUR_ADD = 0xCC9E2D51, 0x1B873593, 0xE6546B64
MURMUR_F1, MURMUR_F2, MURMUR_SEED = 0x85EBCA6B, 0xC2B2AE35, 42


def murmur3(s: Column | str, seed: int = MURMUR_SEED) -> Column:
    """MurmurHash3 (32 bits, x86) of the UTF-8 bytes as a signed int, as HashingTF hashes terms.

    (Spark SQL's ``hash`` treats the bytes after the last whole block in a way of its own, so it differs.)"""
    mask = 0xFFFFFFFF

    def let(x: Column, f) -> Column:
        return F.transform(F.array(x), f)[0]  # ``x`` is written, and computed, once

    def times(x: Column, c: int) -> Column:  # modulo 2^32, within a long
        return let(x, lambda v: (v * (c & 0xFFFF) + F.shiftleft((v * (c >> 16)).bitwiseAND(0xFFFF), 16)).bitwiseAND(mask))

    def turn(x: Column, n: int) -> Column:
        return let(x, lambda v: F.shiftleft(v, n).bitwiseAND(mask).bitwiseOR(F.shiftright(v, 32 - n)))

    def shifted(x: Column, n: int) -> Column:
        return let(x, lambda v: v.bitwiseXOR(F.shiftright(v, n)))

    def block(hexed: Column) -> Column:  # four bytes, the first the lowest
        pair = lambda at: F.substr(hexed, F.lit(at), F.lit(2))
        return F.conv(F.concat(pair(7), pair(5), pair(3), pair(1)), 16, 10).cast("long")

    def mixed(k: Column) -> Column:
        return times(turn(times(k, MURMUR_C1), 15), MURMUR_C2)

    hexed = F.hex(F.encode(col_(s), "UTF-8"))
    blocks = F.regexp_extract_all(hexed, F.lit("([0-9A-F]{8})"), 1)
    body = F.aggregate(
        blocks,
        F.lit(seed).cast("long"),
        lambda h, u: (times(turn(h.bitwiseXOR(mixed(block(u))), 13), 5) + MURMUR_ADD).bitwiseAND(mask),
    )
    rest = F.rpad(F.substr(hexed, F.size(blocks) * 8 + 1), 8, "0")
    h = body.bitwiseXOR(mixed(block(rest))).bitwiseXOR((F.length(hexed) / 2).cast("long"))
    h = shifted(times(shifted(times(shifted(h, 16), MURMUR_F1), 13), MURMUR_F2), 16)
    return let(h, lambda v: F.when(v >= 2**31, v - 2**32).otherwise(v)).cast("int")


# message parsing (R2) ---------------------------------------------------------
def parse_message(msg: Column | str) -> Column:
    """``userId|productId|score|timestamp`` -> struct; malformed fields become null."""
    parts = split_literal(msg, MESSAGE_SEPARATOR)
    return F.struct(
        java_trim(field(parts, 0)).try_cast("int").alias("userId"),
        java_trim(field(parts, 1)).try_cast("int").alias("productId"),
        java_trim(field(parts, 2)).try_cast("double").alias("score"),
        java_trim(field(parts, 3)).try_cast("long").alias("timestamp"),
    )


def format_message(user_id, product_id, score, ts) -> Column:
    return F.concat_ws(
        MESSAGE_SEPARATOR,
        col_(user_id).cast("string"),
        col_(product_id).cast("string"),
        col_(score).cast("string"),
        col_(ts).cast("string"),
    )
