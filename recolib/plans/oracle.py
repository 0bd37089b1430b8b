"""DuckDB SQL equivalents of the catalogue, over the raw test tables.

Each entry is a full statement: the fixture mapping as CTEs, then the query.
Column names and types match the Spark side; doubles are rounded to 6 places.
"""

from __future__ import annotations

# Fixture CTEs; each may use the ones before it.
CTES: dict[str, str] = {
    "ratings": """ratings AS (
  SELECT CAST(o_custkey AS BIGINT) AS userId, CAST(l_partkey AS BIGINT) AS productId,
         CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS score,
         CAST(floor(epoch(l_shipdate)) AS BIGINT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "products": """products AS (
  SELECT CAST(p_partkey AS BIGINT) AS productId, p_name AS name,
         'img/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS imageUrl, p_type AS categories,
         concat_ws('|', replace(p_name, ' ', '|'), p_brand, p_type) AS tags
  FROM part)""",
    "users": """users AS (
  SELECT CAST(c_custkey AS BIGINT) AS userId, c_name AS username FROM customer)""",
    "ev": """ev AS (
  SELECT event_id, event_type, CAST(user_id AS BIGINT) AS userId,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS productId,
         CAST(least(10, 1 + floor(value / 10)) AS DOUBLE) / 2 AS score,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp"
  FROM events)""",
    "avg": """avgp AS (
  SELECT productId, avg(score) AS avg FROM ratings GROUP BY productId)""",
    "enriched": """enriched AS (
  SELECT p.productId, p.name, p.imageUrl, p.categories, p.tags, coalesce(a.avg, 0.0) AS score
  FROM products p LEFT JOIN avgp a ON p.productId = a.productId)""",
    # item-CF
    "cf": """n AS (SELECT productId, count(*) AS n FROM ratings GROUP BY productId),
rc AS (SELECT r.userId, r.productId, n.n FROM ratings r JOIN n ON r.productId = n.productId),
co AS (SELECT a.productId AS p1, b.productId AS p2, count(*) AS c, a.n AS n1, b.n AS n2
       FROM rc a JOIN rc b ON a.userId = b.userId
       WHERE a.productId <> b.productId
       GROUP BY a.productId, b.productId, a.n, b.n),
cfsc AS (SELECT p1, p2, c, c / sqrt(CAST(n1 AS DOUBLE) * CAST(n2 AS DOUBLE)) AS s FROM co),
cfrk AS (SELECT p1, p2, s, row_number() OVER (PARTITION BY p1 ORDER BY round(s, 9) DESC, p2) AS rn
         FROM cfsc),
cftop AS (SELECT p1 AS productId, CAST(rn AS INTEGER) AS "rank", p2 AS simProductId, s AS score
          FROM cfrk WHERE rn <= 10)""",
    # content TF-IDF over the exact vocabulary
    "tfidf": """tok AS (SELECT productId, unnest(string_split(rtrim(lower(replace(rtrim(tags, '|'), '|', ' '))), ' ')) AS term
         FROM products),
tf AS (SELECT productId, term, count(*) AS tf FROM tok GROUP BY productId, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
m AS (SELECT count(*) AS m FROM products),
v AS (SELECT tf.productId, tf.term, tf.tf, df.df, tf.tf * ln((m.m + 1.0) / (df.df + 1.0)) AS weight
      FROM tf JOIN df ON tf.term = df.term CROSS JOIN m)""",
    "sim": """nm AS (SELECT productId, sqrt(sum(weight * weight)) AS nrm FROM v GROUP BY productId),
dp AS (SELECT a.productId AS i, b.productId AS j, sum(a.weight * b.weight) AS d
       FROM v a JOIN v b ON a.term = b.term AND a.productId <> b.productId GROUP BY a.productId, b.productId),
sim AS (SELECT i AS productId, j AS simProductId, d / (na.nrm * nb.nrm) AS score
        FROM dp JOIN nm na ON na.productId = i JOIN nm nb ON nb.productId = j
        WHERE na.nrm > 0 AND nb.nrm > 0 AND d / (na.nrm * nb.nrm) > 0.4)""",
    # online scoring, latest event per user
    "online": """e AS (SELECT ev.*, row_number() OVER (PARTITION BY userId ORDER BY "timestamp" DESC, event_id DESC) AS rn
      FROM ev),
rec AS (SELECT userId, productId, score FROM e WHERE rn <= 21),
rated AS (SELECT userId, productId FROM ev UNION SELECT userId, productId FROM ratings),
candall AS (SELECT l.userId, sim.simProductId AS c, sim.score AS s,
                   row_number() OVER (PARTITION BY l.userId ORDER BY round(sim.score, 9) DESC, sim.simProductId) AS k
            FROM e l JOIN sim ON sim.productId = l.productId
            LEFT JOIN rated x ON x.userId = l.userId AND x.productId = sim.simProductId
            WHERE l.rn = 1 AND x.productId IS NULL),
cand AS (SELECT userId, c, s, k FROM candall WHERE k <= 20),
pr AS (SELECT cand.userId, cand.c, sim.score * rec.score AS w, rec.score AS rs
       FROM cand JOIN rec ON rec.userId = cand.userId
       JOIN sim ON sim.productId = cand.c AND sim.simProductId = rec.productId),
onl AS (SELECT userId, c AS productId,
               avg(w) + log10(greatest(1, sum(CASE WHEN rs > 3 THEN 1 ELSE 0 END)))
                      - log10(greatest(1, sum(CASE WHEN rs <= 3 THEN 1 ELSE 0 END))) AS score
        FROM pr GROUP BY userId, c)""",
}

ORDER = list(CTES)


def with_ctes(body: str, *names: str) -> str:
    need = [n for n in ORDER if n in names]
    head = "WITH " + ",\n".join(CTES[n] for n in need)
    # a body may open with more CTEs of its own
    sep = "\n" if body.lstrip().upper().startswith("SELECT") else ",\n"
    return head + sep + body


SQL: dict[str, str] = {}

SQL["ratings_projection"] = with_ctes("SELECT * FROM ratings", "ratings")
SQL["products_projection"] = with_ctes(
    "SELECT *, replace(rtrim(tags, '|'), '|', ' ') AS tag_words FROM products", "products")
SQL["product_text_parse"] = with_ctes(
    "SELECT productId, trim(name) AS name, trim(imageUrl) AS imageUrl, trim(categories) AS categories, "
    "trim(tags) AS tags FROM products", "products")
SQL["rating_csv_parse"] = with_ctes("SELECT * FROM ratings", "ratings")
SQL["log_filter_parse"] = with_ctes(
    'SELECT userId, productId, score, "timestamp" FROM ev WHERE event_type = \'purchase\'', "ev")
SQL["log_event_format"] = with_ctes(
    "SELECT event_id, 'PRODUCT_RATING_PREFIX:' || CAST(userId AS VARCHAR) || '|' || CAST(productId AS VARCHAR) "
    "|| '|' || CAST(score AS VARCHAR) || '|' || CAST(\"timestamp\" AS VARCHAR) AS line FROM ev", "ev")
SQL["score_normalise"] = """SELECT event_id, CAST(least(10, 1 + floor(value / 10)) AS INTEGER) AS raw,
  round(CAST(least(10, 1 + floor(value / 10)) AS DOUBLE) / 2, 2) AS score FROM events"""
SQL["charset_redecode"] = """SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars,
  CAST(octet_length(encode(text)) AS INTEGER) AS garbled_chars, md5(text) AS restored_md5,
  md5(regexp_replace(regexp_replace(text, '[^\\x{00}-\\x{FF}]', '?', 'g'), '[\\x{80}-\\x{FF}]', chr(65533), 'g')) AS plain_md5
  FROM documents"""
SQL["user_id_hash"] = with_ctes(
    """SELECT userId, username, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS hashId
FROM (SELECT userId, username,
        list_reduce(list_transform(string_split(username, ''), lambda x: CAST(ascii(x) AS BIGINT)),
                    lambda acc, x: (acc * 31 + x) % 4294967296, CAST(0 AS BIGINT)) AS h FROM users) t""", "users")

SQL["rate_more_products"] = with_ctes(
    'SELECT productId, count(productId) AS "count" FROM ratings GROUP BY productId', "ratings")
SQL["rate_more_recently_products"] = with_ctes(
    """SELECT productId, count(productId) AS "count", yearmonth
FROM (SELECT productId, strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000), '%Y%m') AS yearmonth
      FROM ratings) t GROUP BY yearmonth, productId""", "ratings")
SQL["average_products"] = with_ctes(
    "SELECT productId, round(avg(score), 6) AS avg FROM ratings GROUP BY productId", "ratings")

_ENR = "e.productId, e.name, e.imageUrl, e.categories, e.tags, round(e.score, 6) AS score"
SQL["product_enriched"] = with_ctes(
    f"SELECT {_ENR} FROM enriched e", "ratings", "products", "avg", "enriched")
SQL["hot_products"] = with_ctes(
    f"""SELECT {_ENR} FROM enriched e WHERE e.productId IN (
  SELECT productId FROM (
    SELECT productId, count(*) AS c, strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000), '%Y%m') AS ym
    FROM ratings GROUP BY ym, productId) h
  ORDER BY ym DESC, c DESC, productId LIMIT 20)""", "ratings", "products", "avg", "enriched")
SQL["most_rated_products"] = with_ctes(
    f"""SELECT {_ENR} FROM enriched e WHERE e.productId IN (
  SELECT productId FROM ratings GROUP BY productId ORDER BY count(*) DESC, productId LIMIT 20)""",
    "ratings", "products", "avg", "enriched")
SQL["product_by_id"] = with_ctes(
    f"SELECT {_ENR} FROM enriched e WHERE e.productId IN (SELECT productId FROM ev)",
    "ratings", "products", "ev", "avg", "enriched")
SQL["product_search_regex"] = with_ctes(
    f"SELECT {_ENR} FROM enriched e WHERE regexp_matches(e.name, '^blue|ring$')",
    "ratings", "products", "avg", "enriched")
SQL["recs_to_products"] = with_ctes(
    f"""SELECT q.queryId, {_ENR} FROM (
  SELECT DISTINCT productId AS queryId, simProductId FROM cftop
  WHERE productId IN (SELECT productId FROM ev)) q JOIN enriched e ON e.productId = q.simProductId""",
    "ratings", "products", "ev", "avg", "enriched", "cf")

SQL["item_cf_pairs"] = with_ctes(
    "SELECT p1 AS productId, p2 AS simProductId, c AS co, round(s, 6) AS score FROM cfsc", "ratings", "cf")
SQL["item_cf_top10"] = with_ctes(
    'SELECT productId, "rank", simProductId, round(score, 6) AS score FROM cftop', "ratings", "cf")
SQL["item_cf_list_sizes"] = with_ctes(
    """SELECT r.productId, CAST(count(t.simProductId) AS BIGINT) AS list_size
FROM (SELECT DISTINCT productId FROM ratings) r LEFT JOIN cftop t ON t.productId = r.productId
GROUP BY r.productId""", "ratings", "cf")

SQL["tfidf_weights"] = with_ctes(
    "SELECT productId, term, tf, df, round(weight, 6) AS weight FROM v", "products", "tfidf")
SQL["content_pairs"] = with_ctes(
    "SELECT productId, simProductId, round(score, 6) AS score FROM sim", "products", "tfidf", "sim")
_CONTENT_RANKED = """SELECT productId, CAST(row_number() OVER (PARTITION BY productId
    ORDER BY round(score, 9) DESC, simProductId) AS INTEGER) AS "rank", simProductId, round(score, 6) AS score
FROM sim"""
SQL["content_recs"] = with_ctes(_CONTENT_RANKED, "products", "tfidf", "sim")
SQL["similarity_flatten"] = SQL["content_recs"]

# the hashed form: a term's bucket is Murmur3 (x86, 32 bits, seed 42) of its UTF-8 bytes modulo 800. Words of four
# bytes, little-endian, are mixed and folded one by one; the last 0 to 3 bytes are one more word.
SQL["hashed_tfidf"] = with_ctes(
    """term AS (SELECT DISTINCT term, hex(encode(term)) AS h, octet_length(encode(term)) AS n FROM tok),
word AS (SELECT term, n, i, CAST('0x0' || string_agg(substr(h, 8 * i + 2 * b + 1, 2), '' ORDER BY b DESC) AS UBIGINT) AS k
         FROM (SELECT *, unnest(range(n // 4 + 1)) AS i FROM term), range(4) t(b) GROUP BY term, n, i),
turned AS (SELECT term, i, (((k * 3432918353 & 4294967295) << 15) | ((k * 3432918353 & 4294967295) >> 17)) & 4294967295 AS k
           FROM word),
mixed AS (SELECT term, i, k * 461845907 & 4294967295 AS k FROM turned),
folded AS (SELECT term, n, 0::BIGINT AS i, 42::UBIGINT AS s FROM term
           UNION ALL
           SELECT f.term, f.n, f.i + 1,
                  (((xor(f.s, m.k) << 13) | (xor(f.s, m.k) >> 19)) & 4294967295) * 5 + 3864292196 & 4294967295
           FROM folded f JOIN mixed m ON m.term = f.term AND m.i = f.i WHERE f.i < f.n // 4),
whole AS (SELECT f.term, xor(xor(f.s, m.k), f.n::UBIGINT) AS s
          FROM folded f JOIN mixed m ON m.term = f.term AND m.i = f.i WHERE f.i = f.n // 4),
end1 AS (SELECT term, xor(s, s >> 16) * 2246822507 & 4294967295 AS s FROM whole),
end2 AS (SELECT term, xor(s, s >> 13) * 3266489909 & 4294967295 AS s FROM end1),
end3 AS (SELECT term, xor(s, s >> 16)::BIGINT AS s FROM end2),
bucket AS (SELECT term, (((CASE WHEN s >= 2147483648 THEN s - 4294967296 ELSE s END) % 800) + 800) % 800 AS bucket FROM end3),
htf AS (SELECT productId, bucket, count(*) AS tf FROM tok JOIN bucket USING (term) GROUP BY productId, bucket),
hdf AS (SELECT bucket, count(*) AS df FROM htf GROUP BY bucket),
hv AS (SELECT productId, bucket, tf * ln((m.m + 1.0) / (df + 1.0)) AS weight FROM htf JOIN hdf USING (bucket) CROSS JOIN m),
hn AS (SELECT productId, sqrt(sum(weight * weight)) AS norm FROM hv GROUP BY productId),
hd AS (SELECT a.productId, b.productId AS simProductId, sum(a.weight * b.weight) AS dot FROM hv a
       JOIN hv b ON a.bucket = b.bucket AND a.productId <> b.productId GROUP BY a.productId, b.productId)
SELECT hd.productId, simProductId, round(dot / (a.norm * b.norm), 6) AS score FROM hd
JOIN hn a ON a.productId = hd.productId JOIN hn b ON b.productId = simProductId
WHERE a.norm > 0 AND b.norm > 0 AND dot / (a.norm * b.norm) > 0.4""", "products", "tfidf").replace("WITH ", "WITH RECURSIVE ", 1)

SQL["recent_ratings_k"] = with_ctes(
    """SELECT userId, CAST(rn AS INTEGER) AS "rank", productId, score FROM (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY "timestamp" DESC, event_id DESC) AS rn FROM ev) t
WHERE rn <= 21""", "ev")
SQL["recent_queue_cap"] = with_ctes(
    """SELECT userId, CAST(rn AS INTEGER) AS "rank", CAST(productId AS VARCHAR) || ':' || CAST(score AS VARCHAR) AS item
FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY "timestamp" DESC, event_id DESC) AS rn FROM ev) t
WHERE rn <= 40""", "ev")
SQL["online_candidates"] = with_ctes(
    'SELECT userId, CAST(k AS INTEGER) AS "rank", c AS productId, round(s, 6) AS sim FROM cand',
    "ratings", "products", "ev", "tfidf", "sim", "online")
SQL["online_recs"] = with_ctes(
    """SELECT userId, CAST(row_number() OVER (PARTITION BY userId ORDER BY round(score, 9) DESC, productId) AS INTEGER) AS "rank",
  productId, round(score, 6) AS score FROM onl""", "ratings", "products", "ev", "tfidf", "sim", "online")
SQL["online_recs_asof"] = with_ctes(
    """sq AS (SELECT ev.*, row_number() OVER (PARTITION BY userId ORDER BY "timestamp", event_id) AS seq FROM ev),
fs AS (SELECT userId, productId, min(seq) AS first_seq FROM sq GROUP BY userId, productId),
ca AS (SELECT t.event_id, t.userId, sim.simProductId AS c, sim.score AS s,
              row_number() OVER (PARTITION BY t.event_id ORDER BY round(sim.score, 9) DESC, sim.simProductId) AS k
       FROM sq t JOIN sim ON sim.productId = t.productId
       LEFT JOIN fs ON fs.userId = t.userId AND fs.productId = sim.simProductId
       WHERE (fs.first_seq IS NULL OR fs.first_seq > t.seq)
         AND (t.userId, sim.simProductId) NOT IN (SELECT (userId, productId) FROM ratings)),
cd AS (SELECT event_id, userId, c FROM ca WHERE k <= 20),
rc AS (SELECT t.event_id, h.productId, h.score FROM sq t JOIN sq h
       ON h.userId = t.userId AND h.seq BETWEEN t.seq - 20 AND t.seq),
pr AS (SELECT cd.event_id, cd.userId, cd.c, sim.score * rc.score AS w, rc.score AS rs
       FROM cd JOIN rc ON rc.event_id = cd.event_id
       JOIN sim ON sim.productId = cd.c AND sim.simProductId = rc.productId)
SELECT event_id, userId, c AS productId,
       round(avg(w) + log10(greatest(1, sum(CASE WHEN rs > 3 THEN 1 ELSE 0 END)))
                    - log10(greatest(1, sum(CASE WHEN rs <= 3 THEN 1 ELSE 0 END))), 6) AS score
FROM pr GROUP BY event_id, userId, c""",
    "ratings", "products", "ev", "tfidf", "sim")

SQL["rating_upsert"] = with_ctes(
    """evl AS (SELECT userId, productId, score FROM (
    SELECT *, row_number() OVER (PARTITION BY userId, productId ORDER BY "timestamp" DESC, event_id DESC) AS rn
    FROM ev) t WHERE rn = 1),
evf AS (SELECT userId, productId, min("timestamp") AS first_ts FROM ev GROUP BY userId, productId),
st AS (SELECT userId, productId, min("timestamp") AS base_ts FROM ratings GROUP BY userId, productId)
SELECT r.userId, r.productId, r.score, CAST(r."timestamp" AS BIGINT) AS "timestamp" FROM ratings r
WHERE NOT EXISTS (SELECT 1 FROM evf WHERE evf.userId = r.userId AND evf.productId = r.productId)
UNION ALL
SELECT l.userId, l.productId, l.score, CAST(coalesce(st.base_ts, f.first_ts) AS BIGINT) AS "timestamp"
FROM evl l JOIN evf f ON f.userId = l.userId AND f.productId = l.productId
LEFT JOIN st ON st.userId = l.userId AND st.productId = l.productId""", "ratings", "ev")

SQL["stream_recs_lookup"] = with_ctes(
    f"""SELECT q.username, {_ENR} FROM (
  SELECT DISTINCT u.username, o.productId FROM onl o JOIN users u ON u.userId = o.userId) q
JOIN enriched e ON e.productId = q.productId""",
    "ratings", "products", "users", "ev", "avg", "enriched", "tfidf", "sim", "online")

_FACTORS = """uf AS (SELECT CAST(vec_id // 2 AS BIGINT) AS userId, CAST(embedding AS DOUBLE[]) AS f
       FROM embeddings WHERE vec_id % 2 = 0),
itf AS (SELECT CAST((vec_id - 1) // 2 AS BIGINT) AS productId, CAST(embedding AS DOUBLE[]) AS f
        FROM embeddings WHERE vec_id % 2 = 1),
fsc AS (SELECT uf.userId, itf.productId, list_dot_product(uf.f, itf.f) AS s FROM uf CROSS JOIN itf),
frk AS (SELECT userId, productId, s,
               row_number() OVER (PARTITION BY userId ORDER BY round(s, 9) DESC, productId) AS rn FROM fsc),
ftop AS (SELECT userId, CAST(rn AS INTEGER) AS "rank", productId, s AS score FROM frk WHERE rn <= 50)"""
SQL["factor_topk"] = "WITH " + _FACTORS + """
SELECT userId, "rank", productId, round(score, 6) AS score FROM ftop"""
SQL["offline_recs_lookup"] = with_ctes(
    _FACTORS + f"""
SELECT q.username, {_ENR} FROM (
  SELECT DISTINCT u.username, t.productId FROM ftop t JOIN users u ON u.userId = t.userId) q
JOIN enriched e ON e.productId = q.productId""", "ratings", "products", "users", "avg", "enriched")

SQL["rmse_eval"] = with_ctes(
    """sp AS (SELECT *, ('0x' || substr(md5(userId || ':' || productId), 1, 8))::BIGINT % 10000 < 8000 AS tr
       FROM ratings),
mn AS (SELECT productId, avg(score) AS prediction FROM sp WHERE tr GROUP BY productId)
SELECT count(*) AS n, round(sqrt(avg((t.score - mn.prediction) * (t.score - mn.prediction))), 6) AS rmse
FROM sp t JOIN mn ON mn.productId = t.productId WHERE NOT t.tr""", "ratings")

# a fitted model's lists: one for every rated user and product, full, equal to the exact search over its factors
for _name, _key, _other in (("als_user_lists_check", "userId", "productId"), ("als_item_lists_check", "productId", "userId")):
    SQL[_name] = with_ctes(
        f"""SELECT {_key}, least(50, (SELECT count(DISTINCT {_other}) FROM ratings)) AS list_size, TRUE AS same_scores,
  TRUE AS descending FROM ratings GROUP BY {_key}""", "ratings")
# held-out ratings of users and products that the training part has get a prediction, the others are dropped
SQL["als_predictions"] = with_ctes(
    """sp AS (SELECT *, ('0x' || substr(md5(userId || ':' || productId), 1, 8))::BIGINT % 10000 < 8000 AS tr FROM ratings)
SELECT t.userId, t.productId, count(*) AS n, TRUE AS predicted FROM sp t
WHERE NOT t.tr AND t.userId IN (SELECT userId FROM sp WHERE tr) AND t.productId IN (SELECT productId FROM sp WHERE tr)
GROUP BY t.userId, t.productId""", "ratings")

SQL["stream_log_filter"] = SQL["log_filter_parse"]
SQL["stream_online_recs"] = SQL["online_recs"]

SQL["content_recs_to_products"] = with_ctes(
    f"""SELECT q.queryId, {_ENR} FROM (
  SELECT DISTINCT productId AS queryId, simProductId FROM sim
  WHERE productId IN (SELECT productId FROM ev)) q JOIN enriched e ON e.productId = q.simProductId""",
    "ratings", "products", "ev", "avg", "enriched", "tfidf", "sim")
SQL["recs_ranked_products"] = with_ctes(
    f"""SELECT t.productId AS queryId, t."rank", round(t.score, 6) AS sim, {_ENR}
FROM cftop t JOIN enriched e ON e.productId = t.simProductId
WHERE t.productId IN (SELECT productId FROM ev)""", "ratings", "products", "ev", "avg", "enriched", "cf")

SQL["rate_more_recently_ranked"] = with_ctes(
    """SELECT productId, "count", yearmonth, CAST(row_number() OVER (PARTITION BY yearmonth
    ORDER BY "count" DESC, productId) AS INTEGER) AS "rank"
FROM (SELECT productId, count(productId) AS "count", yearmonth
      FROM (SELECT productId, strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000), '%Y%m') AS yearmonth
            FROM ratings) t GROUP BY yearmonth, productId) u""", "ratings")
SQL["rating_ingest"] = with_ctes(
    """SELECT event_id, userId, productId, score, "timestamp",
  concat('PRODUCT_RATING_PREFIX:', concat_ws('|', CAST(userId AS VARCHAR), CAST(productId AS VARCHAR),
         CAST(score AS VARCHAR), CAST("timestamp" AS VARCHAR))) AS line FROM ev""", "ev")

# lookups in stored results give the rows of the lookups that build them
for _name in ("hot_products", "product_by_id", "product_search_regex", "rating_upsert", "recs_to_products", "content_recs_to_products",
              "offline_recs_lookup"):
    SQL[f"stored_{_name}"] = SQL[_name]

# statistics kept up by the stream: those of ratings and events together
_RATED = """rated AS (SELECT productId, score, "timestamp" FROM ratings
  UNION ALL SELECT productId, score, "timestamp" FROM ev WHERE productId IS NOT NULL)
"""
SQL["stream_rate_more_products"] = with_ctes(
    _RATED + 'SELECT productId, count(*) AS "count" FROM rated GROUP BY productId', "ratings", "ev")
SQL["stream_rate_more_recently_products"] = with_ctes(
    _RATED + """SELECT productId, count(*) AS "count", yearmonth
FROM (SELECT productId, strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000), '%Y%m') AS yearmonth
      FROM rated) t GROUP BY yearmonth, productId""", "ratings", "ev")
SQL["stream_average_products"] = with_ctes(
    _RATED + "SELECT productId, round(avg(score), 6) AS avg FROM rated GROUP BY productId", "ratings", "ev")
