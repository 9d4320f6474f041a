"""Operator 6: mixing sources to target weights by min-cost flow.

A document may belong to several sources. Spark aggregates documents by membership
pattern; on the driver a small network (one node a pattern, one a source) routes each pattern's words to
the sources' quotas. A pattern offers its words once at cost 0 and again, up to ``max_repeats``
times, at rising cost, so nothing repeats while fresh words can still fill a quota. Each pattern's routed words are
then turned into documents: all of them as often as the flow goes round whole, and a seeded
share of them once more.

The seeded share is taken in the order of a 60-bit hash of the id. The hash value up to which documents are
taken is found level by level, 16 ways at a time, from sums that Spark pre-aggregates, each pattern for as many levels
as its own size asks for; its last few hundred documents around it (all of them, if it has no more) are filled first-fit,
so the words taken come within a few of the quota. No group is ever gathered or sorted whole, however large.

What the driver holds is one row per membership pattern (for single sources: per source). These rows, with at most FILL
picks each, are broadcast, so that texts are never dealt by pattern.

Defined results: null and wordless texts have size 0 and are taken 0 times; null source is a source of its own
(last in order); rows with the same id and size are taken or left together; an empty table gives no
rows; other columns, whatever their names, are ignored by ``mix``.
"""

from __future__ import annotations

from collections import defaultdict, deque

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.text import take_columns, word_count

WEIGHTS = (5, 2, 1)  # by source in code point order, repeating
TARGET_SHARE = (3, 2)  # targets add up to 150 % of all words
MAX_REPEATS = 2
SEED = 7
FILL = 512  # documents around the cut that are filled first-fit
HASH_BITS = 60
LEVEL_BITS = 4


def targets(sizes: dict, weights=WEIGHTS, share=TARGET_SHARE, most: int = MAX_REPEATS) -> dict:
    """Target words of each source: shares by weight, held at ``most`` times the source's
    words, the excess shared again by weight among the others until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, live = {}, list(order)
    top, bottom = share
    left = top * sum(sizes.values())  # in units of 1/bottom words, so that sums stay whole
    while live:
        w = sum(weight[s] for s in live)
        above = [s for s in live if left * weight[s] > most * sizes[s] * bottom * w]
        if not above:
            out.update({s: left * weight[s] / (bottom * w) for s in live})
            break
        for s in above:
            out[s] = float(most * sizes[s])
            left -= most * sizes[s] * bottom
            live.remove(s)
    return out


def route(patterns: dict[tuple, int], quotas: dict, most: int = MAX_REPEATS) -> dict[tuple, int]:
    """Words taken from each pattern by a cheapest largest flow into the sources' quotas.

    The cost of a pattern's r-th round rises with r alike for all patterns, so augmenting with all
    first rounds open, then all second rounds, and so on, keeps the flow cheapest.
    """
    flow: dict[tuple, dict] = {p: dict.fromkeys(p, 0) for p in patterns}
    used = dict.fromkeys(patterns, 0)
    room = dict(quotas)
    at_source = defaultdict(list)
    for p in patterns:
        for s in p:
            at_source[s].append(p)
    for r in range(1, most + 1):
        for p, words in patterns.items():
            while used[p] < r * words:
                # Breadth-first search for a source with room, through patterns that can reroute.
                back, queue, end = {("p", p): None}, deque([("p", p)]), None
                while queue and end is None:
                    kind, x = node = queue.popleft()
                    if kind == "p":
                        for s in x:
                            if ("s", s) not in back:
                                back["s", s] = node
                                if room[s] > 0:
                                    end = ("s", s)
                                    break
                                queue.append(("s", s))
                    else:
                        for q in at_source[x]:
                            if flow[q][x] > 0 and ("p", q) not in back:
                                back["p", q] = node
                                queue.append(("p", q))
                if end is None:
                    break
                path = [end]
                while back[path[-1]] is not None:
                    path.append(back[path[-1]])
                path.reverse()  # p, s, q, s', ... , end
                steps = list(zip(path, path[1:]))
                amount = min(r * words - used[p], room[end[1]])
                for a, b in steps:
                    if a[0] == "s":
                        amount = min(amount, flow[b[1]][a[1]])
                for a, b in steps:
                    if a[0] == "p":
                        flow[a[1]][b[1]] += amount
                    else:
                        flow[b[1]][a[1]] -= amount
                used[p] += amount
                room[end[1]] -= amount
    return used


def order_hash(seed: int) -> Column:
    """60 bits that order the documents of a pattern."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "size"), 64 - HASH_BITS)


def _fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """First-fit over the few documents around a pattern's cut, then one more if that comes nearer."""
    pdf = pdf.sort_values("h")
    rest, picks, left = int(pdf["rest"].iloc[0]), [], []
    for h, size in zip(pdf["h"], pdf["size"]):
        if size <= rest:
            rest -= int(size)
            picks.append(int(h))
        else:
            left.append((int(size), int(h)))
    if left and min(left)[0] - rest < rest:
        picks.append(min(left)[1])
    return pd.DataFrame({"pattern_id": [int(pdf["pattern_id"].iloc[0])], "picks": [picks]})


def selection(rows: DataFrame, plan: list[tuple[int, int, int]]) -> DataFrame:
    """(pattern_id, base, cut, picks) from rows (pattern_id, size, h) and the plan's (pattern_id, base, rest).

    A document is taken ``base`` times, and once more if h < cut or h is among the picks.
    """
    spark = rows.sparkSession
    state = {pid: [base, 0, rest, 1 << HASH_BITS] for pid, base, rest in plan}  # base, cut, rest, span
    deciding = {pid for pid, _, rest in plan if rest > 0}
    narrowing = set(deciding)
    width = HASH_BITS
    schema = "pattern_id long, base long, cut long, rest long, span long, deciding boolean, narrowing boolean"

    def as_table() -> DataFrame:
        return spark.createDataFrame([(p, *state[p], p in deciding, p in narrowing) for p in state], schema)

    def undecided(which: str) -> DataFrame:
        near = rows.join(F.broadcast(as_table().where(which)), "pattern_id")
        return near.where((F.col("h") >= F.col("cut")) & (F.col("h") - F.col("cut") < F.col("span")))

    while narrowing and width > 0:
        width -= LEVEL_BITS
        digit = F.shiftright(F.col("h") - F.col("cut"), width).alias("digit")
        sums = undecided("narrowing").groupBy("pattern_id", digit)
        by: dict = defaultdict(lambda: ([0] * 16, [0] * 16))  # words and documents of each digit
        for p, d, words, n in sums.agg(F.sum("size"), F.count(F.lit(1))).collect():  # 16 a pattern
            by[p][0][d], by[p][1][d] = words, n
        for p in list(narrowing):
            words, n = by[p]
            _, cut, rest, _ = state[p]
            at = 0
            while at < 15 and words[at] <= rest:
                rest -= words[at]
                at += 1
            low, high = at, at + 1
            if n[at] <= FILL:  # few enough: as many neighbours as first-fit may have
                grows = True
                while grows:
                    grows = False
                    if high < 16 and sum(n[low : high + 1]) <= FILL:
                        high, grows = high + 1, True
                    if low > 0 and sum(n[low - 1 : high]) <= FILL:
                        low, grows = low - 1, True
                        rest += words[low]
                narrowing.discard(p)
            state[p][1:] = [cut + (low << width), rest, (high - low) << width]
    table = as_table()
    units = undecided("deciding").groupBy("pattern_id", "h", "rest").agg(F.sum("size").alias("size"))
    picks = units.groupBy("pattern_id").applyInPandas(_fill, "pattern_id long, picks array<long>")
    return table.join(picks, "pattern_id", "left").select(
        "pattern_id", "base", "cut", F.coalesce("picks", F.array().cast("array<long>")).alias("picks")
    )


def with_copies(documents: DataFrame, sources: Column, seed: int = SEED) -> tuple[DataFrame, list]:
    """Rows (doc: the whole row of ``documents``, size, taken), and the rows (source, source_size, target)."""
    spark = documents.sparkSession
    narrow = documents.select("doc_id", word_count(F.col("text")).alias("size"), sources.alias("pattern"))
    narrow = narrow.checkpoint()  # ids, sizes and patterns only: texts are not read again for each level
    groups = narrow.groupBy("pattern").agg(F.sum("size").alias("words")).collect()  # one row a pattern
    groups.sort(key=lambda g: [(s is None, s or "") for s in g["pattern"]])
    patterns = {tuple(dict.fromkeys(g["pattern"])): 0 for g in groups}
    sizes: dict = defaultdict(int)
    for g in groups:
        key = tuple(dict.fromkeys(g["pattern"]))
        patterns[key] += g["words"]
        for s in key:
            sizes[s] += g["words"]
    goal = targets(dict(sizes))
    used = route(patterns, {s: int(t) for s, t in goal.items()})
    number = {tuple(g["pattern"]): i for i, g in enumerate(groups)}
    plan = []
    for g in groups:
        words, key = g["words"], tuple(dict.fromkeys(g["pattern"]))
        need = used[key] * words // patterns[key] if patterns[key] else 0
        plan.append((number[tuple(g["pattern"])], need // words if words else 0, need % words if words else 0))
    keys = spark.createDataFrame(
        [(i, list(p)) for p, i in number.items()], "pattern_id long, pattern array<string>"
    )
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    rows = narrow.join(F.broadcast(keys.withColumnRenamed("pattern", "key")), same("pattern", "key"))
    rows = rows.select("pattern_id", "size", order_hash(seed).alias("h"))
    chosen = selection(rows, plan).join(keys, "pattern_id").withColumnRenamed("pattern", "key")
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc")
    sized = documents.select(whole, "doc_id", word_count(F.col("text")).alias("size"), sources.alias("pattern"))
    joined = sized.join(F.broadcast(chosen), same("pattern", "key"), "left").withColumn("h", order_hash(seed))
    more = (F.col("h") < F.col("cut")) | F.array_contains("picks", F.col("h"))
    taken = F.col("size") * (F.col("base") + more.cast("long"))
    mixed = joined.select("doc", "size", F.coalesce(taken, F.lit(0).cast("long")).alias("taken"))
    return mixed, [(s, int(sizes[s]), float(goal[s])) for s in sizes]


def mix(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every document, each in its one source."""
    docs = take_columns(documents, {"doc_id": "bigint", "text": "string", "source": "string"})
    mixed, goals = with_copies(docs, F.array("source"), seed)
    table = documents.sparkSession.createDataFrame(goals, "s string, source_size long, target double")
    return mixed.join(table, F.col("doc.source").eqNullSafe(F.col("s")), "left").select(
        "doc.doc_id", "size", "source_size", "target", "taken"
    )


def mixed_documents(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of ``documents`` as the mix takes them: left out, once, or once for each repeat."""
    mixed, _ = with_copies(documents, F.array("source"), seed)
    copies = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    return mixed.select("doc", F.explode(F.array_repeat(F.lit(1), copies))).select("doc.*")
