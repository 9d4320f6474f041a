"""DuckDB SQL twins of the registered queries (the independent correctness oracle).

Conventions shared with the Spark side: doubles rounded to 6 places, ranks by
the rounded value descending then id ascending, ints/bigints cast explicitly.
Table adapters are written once as CTE fragments and composed per query.
"""

from __future__ import annotations

from tastegraph.functions import scalar as S
from tastegraph.operators.factors import DEFAULT_SEED as SPLIT_SEED

# --- adapters (same mapping as tastegraph.sources.tables) --------------------
RATINGS = """
ratings AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS userId,
         CAST(l.l_partkey AS INTEGER) AS productId,
         CAST(ceil(l.l_quantity / 10) AS DOUBLE) AS score,
         CAST(floor(epoch(o.o_orderdate)) AS BIGINT) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

PRODUCTS = """
products AS (
  SELECT CAST(p_partkey AS INTEGER) AS productId,
         p_name AS name,
         CAST(NULL AS VARCHAR) AS imageUrl,
         p_type AS categories,
         array_to_string(list_concat(string_split(p_name, ' '), [p_brand, p_type]), '|') AS tags
  FROM part)"""

USERS = """
users AS (
  SELECT CAST(c_custkey AS INTEGER) AS userId, c_name AS username FROM customer)"""

RATING_EVENTS = """
rating_events AS (
  SELECT CAST(user_id AS INTEGER) AS userId,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS productId,
         round((event_id % 10 + 1) / 2.0, 2) AS score,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
         CAST(event_id AS BIGINT) AS seq
  FROM events WHERE event_type IN ('view', 'click', 'purchase'))"""

HISTORY = (
    RATINGS
    + ","
    + RATING_EVENTS
    + """,
history AS (
  SELECT userId, productId, score, "timestamp", CAST(-1 AS BIGINT) AS seq FROM ratings
  UNION ALL
  SELECT userId, productId, score, "timestamp", seq FROM rating_events)"""
)

AVERAGES = """
averages AS (SELECT productId, avg(score) AS avg FROM ratings GROUP BY productId)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


# --- statistics ---------------------------------------------------------------
RATE_MORE_PRODUCTS = with_(RATINGS) + """
SELECT productId, CAST(count(*) AS BIGINT) AS count FROM ratings GROUP BY productId"""

RATE_MORE_RECENTLY_PRODUCTS = with_(RATINGS) + """
SELECT productId, CAST(count(*) AS BIGINT) AS count, yearmonth
FROM (SELECT productId,
             CAST(year(make_timestamp("timestamp" * 1000000)) * 100
                  + month(make_timestamp("timestamp" * 1000000)) AS INTEGER) AS yearmonth
      FROM ratings)
GROUP BY yearmonth, productId"""

AVERAGE_PRODUCTS = with_(RATINGS) + """
SELECT productId, floor((avg(score)) * 1e6 + 0.5 + 1e-6) / 1e6 AS avg FROM ratings GROUP BY productId"""

RATINGS_TYPED = with_(RATINGS) + """
SELECT userId, productId, score, "timestamp" FROM ratings"""

PRODUCTS_TYPED = with_(PRODUCTS) + """
SELECT productId, name, imageUrl, categories, tags FROM products"""

DISTINCT_USERS_PRODUCTS = with_(RATINGS) + """
SELECT DISTINCT 'user' AS kind, userId AS id FROM ratings
UNION ALL
SELECT DISTINCT 'product' AS kind, productId AS id FROM ratings"""


# --- ItemCF -------------------------------------------------------------------
# Reference semantics: raw self-join of rating rows on userId, self pairs removed.
COOC = """
cnt AS (SELECT productId, count(*) AS n FROM ratings GROUP BY productId),
joined AS (SELECT a.productId AS product1, b.productId AS product2
           FROM ratings a JOIN ratings b ON a.userId = b.userId),
co AS (SELECT product1, product2, CAST(count(*) AS BIGINT) AS cocount,
              CAST(c1.n AS BIGINT) AS count1, CAST(c2.n AS BIGINT) AS count2
       FROM joined JOIN cnt c1 ON c1.productId = product1 JOIN cnt c2 ON c2.productId = product2
       WHERE product1 <> product2
       GROUP BY product1, product2, c1.n, c2.n)"""


def itemcf_lists(k: int, name: str = "itemcf") -> str:
    """CTE ``{name}`` (productId, rank, otherId, score) over ``co``."""
    return f"""
{name} AS (
  SELECT productId, CAST(rank AS INTEGER) AS rank, otherId, score FROM (
    SELECT product1 AS productId, product2 AS otherId,
           floor((cocount / sqrt(count1 * count2)) * 1e6 + 0.5 + 1e-6) / 1e6 AS score,
           row_number() OVER (PARTITION BY product1
                              ORDER BY floor((cocount / sqrt(count1 * count2)) * 1e6 + 0.5 + 1e-6) DESC, product2) AS rank
    FROM co) WHERE rank <= {k})"""


COOCCURRENCE_COUNTS = with_(RATINGS, COOC) + """
SELECT product1, product2, cocount, count1, count2 FROM co"""

ITEMCF_TOP10 = with_(RATINGS, COOC, itemcf_lists(10)) + """
SELECT productId, rank, otherId, score FROM itemcf"""

ITEMCF_RECS_ARRAY = with_(RATINGS, COOC, itemcf_lists(10)) + """
SELECT r.productId, t.rank, t.otherId, t.score
FROM (SELECT DISTINCT productId FROM ratings) r LEFT JOIN itemcf t ON t.productId = r.productId"""


# --- content-based (exact vocabulary TF-IDF) -----------------------------------
def content_exact(doc_cte: str, threshold: float = 0.4) -> str:
    """Ranked neighbours over a CTE ``docs(productId, tags)``."""
    return doc_cte + f""",
toks AS (SELECT productId, unnest(string_split_regex(lower(replace(tags, '|', ' ')), '\\s+')) AS word FROM docs),
terms AS (SELECT productId, word AS term FROM toks WHERE word <> ''),
tf AS (SELECT productId, term, count(*) AS tf FROM terms GROUP BY productId, term),
m AS (SELECT count(*) AS m FROM docs),
dfreq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT tf.productId, tf.term, tf.tf * ln((m.m + 1.0) / (dfreq.df + 1.0)) AS w
      FROM tf JOIN dfreq ON tf.term = dfreq.term CROSS JOIN m),
nz AS (SELECT productId, term, w FROM w WHERE w <> 0),
norms AS (SELECT productId, sqrt(sum(w * w)) AS norm FROM nz GROUP BY productId),
unit AS (SELECT nz.productId, nz.term, nz.w / norms.norm AS w FROM nz JOIN norms ON nz.productId = norms.productId),
dots AS (SELECT a.productId AS productId, b.productId AS otherId, sum(a.w * b.w) AS sim
         FROM unit a JOIN unit b ON a.term = b.term AND a.productId <> b.productId
         GROUP BY a.productId, b.productId),
content AS (
  SELECT productId,
         CAST(row_number() OVER (PARTITION BY productId ORDER BY floor((sim) * 1e6 + 0.5 + 1e-6) DESC, otherId) AS INTEGER) AS rank,
         otherId, floor((sim) * 1e6 + 0.5 + 1e-6) / 1e6 AS score
  FROM dots WHERE sim > {threshold})"""


CONTENT_SIMILAR_EXACT = "WITH " + content_exact(
    PRODUCTS + ", docs AS (SELECT productId, tags FROM products)"
) + """
SELECT productId, rank, otherId, score FROM content"""


def _let(x: str, body: str) -> str:
    """``body`` over ``v``, with ``x`` computed once."""
    return f"list_transform([{x}], lambda v: {body})[1]"


def _times(x: str, c: int) -> str:
    return f"CAST((CAST({x} AS HUGEINT) * {c}) % 4294967296 AS BIGINT)"


def _turn(x: str, n: int) -> str:
    return _let(x, f"((v << {n}) & 4294967295) | (v >> {32 - n})")


def _block(at: str) -> str:
    """Four bytes from hex digit ``at`` on, the first the lowest; missing ones are 0."""
    pairs = " || ".join(f"substr(rpad(substr(hx, {at}, 8), 8, '0'), {k}, 2)" for k in (7, 5, 3, 1))
    return f"CAST('0x' || {pairs} AS BIGINT)"


def murmur_bucket(buckets: int) -> str:
    """CTE ``buckets(word, term)`` over ``toks(word)``: MurmurHash3 (32 bits, seed 42) of the UTF-8 bytes, modulo ``buckets``."""
    mixed = lambda k: _times(_turn(_times(k, S.MURMUR_C1), 15), S.MURMUR_C2)
    step = f"({_times(_turn('xor(h, k)', 13), 5)} + {S.MURMUR_ADD}) & 4294967295"
    shift = lambda x, n: _let(x, f"xor(v, v >> {n})")
    last = shift(_times(shift(_times(shift("h", 16), S.MURMUR_F1), 13), S.MURMUR_F2), 16)
    return f"""
hexed AS (SELECT DISTINCT word, hex(word) AS hx FROM toks WHERE word <> ''),
blocks AS (SELECT word, hx, length(hx) // 8 AS n,
                  list_transform(range(0, length(hx) // 8), lambda i: {mixed(_block("i * 8 + 1"))}) AS ks,
                  {mixed(_block("(length(hx) // 8) * 8 + 1"))} AS tail FROM hexed),
bodies AS (SELECT word, xor(xor(list_reduce(ks, lambda h, k: {step}, CAST({S.MURMUR_SEED} AS BIGINT)), tail), length(hx) // 2) AS h FROM blocks),
finals AS (SELECT word, {last} AS h FROM bodies),
buckets AS (SELECT word, ((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % {buckets} + {buckets}) % {buckets} AS term FROM finals),"""


CONTENT_SIMILAR_HASHED = "WITH " + content_exact(
    PRODUCTS + ", docs AS (SELECT productId, tags FROM products)"
).replace(
    "\nterms AS (SELECT productId, word AS term FROM toks WHERE word <> ''),",
    murmur_bucket(800) + "\nterms AS (SELECT productId, term FROM toks JOIN buckets USING (word)),",
) + """
SELECT productId, rank, otherId, score FROM content"""


# --- evaluation ---------------------------------------------------------------
RMSE_OF_MEAN_PREDICTOR = with_(RATINGS, AVERAGES) + """,
pred AS (SELECT DISTINCT r.userId, r.productId, a.avg AS prediction
         FROM ratings r JOIN averages a ON a.productId = r.productId)
SELECT floor((sqrt(avg((r.score - p.prediction) * (r.score - p.prediction)))) * 1e6 + 0.5 + 1e-6) / 1e6 AS rmse,
       CAST(count(*) AS BIGINT) AS n
FROM ratings r JOIN pred p ON p.userId = r.userId AND p.productId = r.productId"""


# --- rating history -------------------------------------------------------------
NEWEST_FIRST = '"timestamp" DESC, seq DESC, productId DESC, score DESC'

RECENT_K = with_(HISTORY) + f"""
SELECT userId, CAST(pos AS INTEGER) AS pos, productId, score, "timestamp", seq FROM (
  SELECT h.*, row_number() OVER (PARTITION BY userId ORDER BY {NEWEST_FIRST}) AS pos FROM history h)
WHERE pos <= 21"""

QUEUE_ITEMS = with_(RATING_EVENTS) + f"""
SELECT userId, CAST(pos AS INTEGER) AS pos,
       CAST(productId AS VARCHAR) || ':' || CAST(score AS VARCHAR) AS item, productId, score
FROM (SELECT e.*, row_number() OVER (PARTITION BY userId ORDER BY {NEWEST_FIRST}) AS pos
      FROM rating_events e)
WHERE pos <= 40"""

RATING_LATEST = with_(HISTORY) + """
SELECT userId, productId, score, "timestamp", versions FROM (
  SELECT userId, productId, score, "timestamp",
         CAST(count(*) OVER (PARTITION BY userId, productId) AS BIGINT) AS versions,
         row_number() OVER (PARTITION BY userId, productId ORDER BY "timestamp" DESC, seq DESC, score DESC) AS rn
  FROM history)
WHERE rn = 1"""

RATING_EXISTS = with_(RATINGS, RATING_EVENTS) + """,
keys AS (SELECT DISTINCT userId, productId FROM ratings)
SELECT e.userId, e.productId, e.score, e."timestamp", e.seq, (k.userId IS NOT NULL) AS "exists"
FROM rating_events e LEFT JOIN keys k ON k.userId = e.userId AND k.productId = e.productId"""

SCORE_NORMALISED = """
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(event_id % 10 + 1 AS INTEGER) AS raw,
       round((event_id % 10 + 1) / 2.0, 2) AS score
FROM events"""


TIMESTAMPS_IN_SECONDS = with_(RATING_EVENTS) + """
SELECT seq, CASE WHEN seq % 2 = 0 THEN "timestamp" * 1000 + seq % 1000 ELSE "timestamp" END AS raw, "timestamp" FROM rating_events"""

ITEMCF_RECS_MAP = with_(HISTORY, COOC, itemcf_lists(10)) + f""",
newest AS (SELECT userId, max(productId) FILTER (WHERE pos = 1) AS productId,
                  coalesce(max(productId) FILTER (WHERE pos = 2), max(productId) FILTER (WHERE pos = 1)) AS otherId
           FROM (SELECT h.*, row_number() OVER (PARTITION BY userId ORDER BY {NEWEST_FIRST}) AS pos FROM history h)
           WHERE pos <= 2 GROUP BY userId)
SELECT n.userId, n.productId, n.otherId, i.score AS sim
FROM newest n JOIN (SELECT DISTINCT productId FROM ratings) r ON r.productId = n.productId
LEFT JOIN itemcf i ON i.productId = n.productId AND i.otherId = n.otherId"""


# --- real-time scoring over ItemCF top-20 lists ------------------------------------
def realtime_ctes(threshold: float, recent_k: int = 21, limit: int = 20) -> str:
    return f"""
trig AS (SELECT userId, productId, score, "timestamp", seq FROM (
           SELECT e.*, row_number() OVER (PARTITION BY userId ORDER BY "timestamp" DESC, seq DESC) AS rn
           FROM rating_events e) WHERE rn = 1),
seen AS (SELECT DISTINCT userId, productId FROM history),
cand0 AS (SELECT t.userId, s.otherId AS cand, s.score AS sim
          FROM trig t JOIN sims s ON s.productId = t.productId
          WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.userId = t.userId AND seen.productId = s.otherId)),
cands AS (SELECT userId, CAST(crank AS INTEGER) AS rank, cand, sim FROM (
            SELECT c.*, row_number() OVER (PARTITION BY userId ORDER BY floor((sim) * 1e6 + 0.5 + 1e-6) DESC, cand) AS crank
            FROM cand0 c) WHERE crank <= {limit}),
rec AS (SELECT userId, productId, score FROM (
          SELECT h.*, row_number() OVER (PARTITION BY userId ORDER BY {NEWEST_FIRST}) AS pos
          FROM history h WHERE userId IN (SELECT userId FROM trig)) WHERE pos <= {recent_k}),
trip AS (SELECT c.userId, c.cand, r.score AS s, s2.score AS sim2
         FROM cands c JOIN rec r ON r.userId = c.userId
         JOIN sims s2 ON s2.productId = c.cand AND s2.otherId = r.productId
         WHERE s2.score > {threshold}),
agg AS (SELECT userId, cand,
               floor((avg(sim2 * s) + log10(greatest(count(*) FILTER (WHERE s > 3), 1))
                      - log10(greatest(count(*) FILTER (WHERE s <= 3), 1))) * 1e6 + 0.5 + 1e-6) / 1e6 AS score
        FROM trip GROUP BY userId, cand),
realtime AS (SELECT userId,
                    CAST(row_number() OVER (PARTITION BY userId ORDER BY floor((score) * 1e6 + 0.5 + 1e-6) DESC, cand) AS INTEGER) AS rank,
                    cand AS productId, floor((score) * 1e6 + 0.5 + 1e-6) / 1e6 AS score
             FROM agg)"""


REALTIME_SIMS = COOC + "," + itemcf_lists(20, "sims")
REALTIME_ITEMCF_THRESHOLD = 0.05

CANDIDATES = with_(HISTORY, REALTIME_SIMS, realtime_ctes(REALTIME_ITEMCF_THRESHOLD)) + """
SELECT userId, rank, cand AS productId, sim FROM cands"""

REALTIME_SCORES = with_(HISTORY, REALTIME_SIMS, realtime_ctes(REALTIME_ITEMCF_THRESHOLD)) + """
SELECT userId, rank, productId, score FROM realtime"""


# --- served queries -------------------------------------------------------------
YEARMONTH = """CAST(year(make_timestamp("timestamp" * 1000000)) * 100
                  + month(make_timestamp("timestamp" * 1000000)) AS INTEGER)"""

INFO = """
info AS (SELECT p.productId, p.name, p.imageUrl, p.categories, p.tags,
                coalesce(a.avg, 0.0) AS score
         FROM products p LEFT JOIN averages a ON a.productId = p.productId)"""


def hydrated(key: str, lists: str = "lists") -> str:
    return f"""
SELECT l.{key}, l.rank, l.productId, l.recScore, i.name, i.imageUrl, i.categories, i.tags,
       floor((i.score) * 1e6 + 0.5 + 1e-6) / 1e6 AS score
FROM {lists} l JOIN info i ON i.productId = l.productId"""


SERVED_RATE_MORE = with_(RATINGS, PRODUCTS, AVERAGES, INFO) + """,
cnt AS (SELECT productId, count(*) AS count FROM ratings GROUP BY productId),
lists AS (SELECT 'rate' AS list,
                 CAST(row_number() OVER (ORDER BY count DESC, productId) AS INTEGER) AS rank,
                 productId, CAST(count AS DOUBLE) AS recScore
          FROM cnt QUALIFY rank <= 20)""" + hydrated("list")

SERVED_HOT = with_(RATINGS, PRODUCTS, AVERAGES, INFO) + f""",
monthly AS (SELECT productId, yearmonth, count(*) AS count
            FROM (SELECT productId, {YEARMONTH} AS yearmonth FROM ratings)
            GROUP BY productId, yearmonth),
latest AS (SELECT m.* FROM monthly m
           JOIN (SELECT productId, max(yearmonth) AS ym FROM monthly GROUP BY productId) x
             ON x.productId = m.productId AND x.ym = m.yearmonth),
lists AS (SELECT 'hot' AS list,
                 CAST(row_number() OVER (ORDER BY yearmonth DESC, count DESC, productId) AS INTEGER) AS rank,
                 productId, CAST(count AS DOUBLE) AS recScore
          FROM latest QUALIFY rank <= 20)""" + hydrated("list")

SERVED_ITEMCF = with_(RATINGS, PRODUCTS, AVERAGES, INFO, COOC, itemcf_lists(10)) + """,
lists AS (SELECT productId AS sourceId, rank, otherId AS productId, score AS recScore FROM itemcf)""" + hydrated(
    "sourceId"
)

SERVED_CONTENT = "WITH " + content_exact(
    PRODUCTS + ", docs AS (SELECT productId, tags FROM products)"
) + "," + RATINGS + "," + AVERAGES + "," + INFO + """,
lists AS (SELECT productId AS sourceId, rank, otherId AS productId, score AS recScore FROM content)""" + hydrated(
    "sourceId"
)

SERVED_STREAM = with_(HISTORY, PRODUCTS, AVERAGES, INFO, REALTIME_SIMS, USERS,
                      realtime_ctes(REALTIME_ITEMCF_THRESHOLD)) + """,
lists AS (SELECT u.username, r.userId, r.rank, r.productId, r.score AS recScore
          FROM realtime r JOIN (SELECT username, min(userId) AS userId FROM users GROUP BY username) u
            ON u.userId = r.userId)
SELECT l.username, l.userId, l.rank, l.productId, l.recScore, i.name, i.imageUrl, i.categories, i.tags,
       floor((i.score) * 1e6 + 0.5 + 1e-6) / 1e6 AS score
FROM lists l JOIN info i ON i.productId = l.productId"""

PRODUCT_INFO = with_(RATINGS, PRODUCTS, AVERAGES, INFO) + """
SELECT productId, name, imageUrl, categories, tags, floor((score) * 1e6 + 0.5 + 1e-6) / 1e6 AS score FROM info"""

SEARCH_PATTERN = "hot (ring|plate)|^blue"

PRODUCT_SEARCH = with_(RATINGS, PRODUCTS, AVERAGES, INFO) + f"""
SELECT productId, name, imageUrl, categories, tags, floor((score) * 1e6 + 0.5 + 1e-6) / 1e6 AS score FROM info
WHERE regexp_matches(name, '{SEARCH_PATTERN}')"""


# --- logs, messages, loaders, layout -----------------------------------------------
LOG_MESSAGES = """
SELECT CAST(event_id AS BIGINT) AS seq,
       concat_ws('|', CAST(user_id AS INTEGER), CAST(json_extract_string(props, '$.k') AS INTEGER),
                 round((event_id % 10 + 1) / 2.0, 2), CAST(floor(epoch(ts)) AS BIGINT)) AS message
FROM events WHERE event_type IN ('view', 'click', 'purchase')"""

MESSAGE_PARSE = with_(RATING_EVENTS) + """
SELECT userId, productId, score, "timestamp", seq FROM rating_events"""

USER_IDS = """
SELECT CAST(c_custkey AS INTEGER) AS userId, c_name AS username,
       CAST(CASE WHEN length(c_name) = 0 THEN 0 ELSE (
         WITH x AS (SELECT list_reduce(list_transform(string_split(c_name, ''), lambda c: unicode(c)::BIGINT),
                                       lambda h, u: (h * 31 + u) % 4294967296, 0::BIGINT) AS h)
         SELECT CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END FROM x) END AS INTEGER) AS hashedId
FROM customer"""

LOAD_PRODUCTS_TEXT = with_(PRODUCTS) + """
SELECT productId, name, '' AS imageUrl, categories, tags FROM products"""

LOAD_RATINGS_TEXT = RATINGS_TYPED

LAYOUT_BUCKETED_LOOKUP = with_(RATINGS, USERS) + """
SELECT u.userId, u.username, CAST(count(*) AS BIGINT) AS n, floor((avg(r.score)) * 1e6 + 0.5 + 1e-6) / 1e6 AS avg_score
FROM ratings r JOIN users u ON u.userId = r.userId
GROUP BY u.userId, u.username"""

STREAM_RECENT_QUEUE = with_(RATING_EVENTS) + f"""
SELECT userId, CAST(pos AS INTEGER) AS pos, productId, score
FROM (SELECT e.*, row_number() OVER (PARTITION BY userId ORDER BY {NEWEST_FIRST}) AS pos
      FROM rating_events e)
WHERE pos <= 40"""


# What rating requests change: newest rating of each rated key, queues, log lines.
RATE_PRODUCT = with_(HISTORY) + f""",
newest AS (
  SELECT userId, productId, score, "timestamp", CAST(count(*) OVER (PARTITION BY userId, productId) AS BIGINT) AS versions,
         row_number() OVER (PARTITION BY userId, productId ORDER BY "timestamp" DESC, seq DESC, score DESC) AS rn
  FROM history),
touched AS (SELECT DISTINCT userId, productId FROM rating_events),
queues AS (SELECT e.*, row_number() OVER (PARTITION BY userId ORDER BY {NEWEST_FIRST}) AS pos FROM rating_events e)
SELECT 'rating' AS part, userId, productId, score, versions AS n, CAST(NULL AS VARCHAR) AS message
FROM newest JOIN touched USING (userId, productId) WHERE rn = 1
UNION ALL SELECT 'queue', userId, productId, score, pos, NULL FROM queues WHERE pos <= 40
UNION ALL SELECT 'log', NULL, NULL, NULL, seq, message FROM ({LOG_MESSAGES})"""


# --- dense cosine over the embeddings table (M4's operator on given vectors) ---------
EMBEDDING_SIMILAR = """
WITH pairs AS (
  SELECT CAST(a.vec_id AS INTEGER) AS productId, CAST(b.vec_id AS INTEGER) AS otherId,
         list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS sim
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])) > 0
    AND list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) > 0),
ranked AS (
  SELECT productId, otherId, sim,
         row_number() OVER (PARTITION BY productId
                            ORDER BY floor((sim) * 1e6 + 0.5 + 1e-6) DESC, otherId) AS rank
  FROM pairs WHERE sim > 0.4)
SELECT productId, CAST(rank AS INTEGER) AS rank, otherId, floor((sim) * 1e6 + 0.5 + 1e-6) / 1e6 AS score
FROM ranked WHERE rank <= 20"""


CONTENT_SIMILAR_DOCUMENTS = "WITH " + content_exact(
    "docs AS (SELECT CAST(doc_id AS INTEGER) AS productId, text AS tags FROM documents)"
) + """
SELECT productId, rank, otherId, score FROM content"""

TRAIN_TEST_SPLIT = with_(RATINGS) + f"""
SELECT userId, productId, score, "timestamp",
       CASE WHEN left(md5(concat_ws('|', '{SPLIT_SEED}', userId, productId, "timestamp")), 4) < '{int(0.8 * 65536):04x}'
            THEN 'train' ELSE 'test' END AS side
FROM ratings"""

# Every rated user and product, with its factor's residual below the bound.
ALS_RESIDUALS = with_(RATINGS) + """
SELECT 'user' AS kind, userId AS id, CAST(count(*) AS BIGINT) AS n, TRUE AS solved FROM ratings GROUP BY userId
UNION ALL
SELECT 'product', productId, CAST(count(*) AS BIGINT), TRUE FROM ratings GROUP BY productId"""

LOOKUP_ITEMCF = f"""
SELECT * FROM ({ITEMCF_TOP10})
WHERE rank <= 5 AND productId IN (SELECT p_partkey FROM part WHERE p_size = 1)"""

LOAD_RATINGS_QUARANTINE = with_(RATINGS) + """
SELECT userId, productId, score, "timestamp", CAST(NULL AS VARCHAR) AS line FROM ratings
UNION ALL
SELECT NULL, NULL, NULL, NULL, concat_ws(',', userId, '', score, "timestamp") FROM ratings WHERE userId % 50 = 0"""
