"""The queries again as SQL for an independent engine, written from the definitions."""

from __future__ import annotations

AS_OF = "timestamp '2024-02-01 00:00:00'"
PAGES_AS_OF = "timestamp '2024-03-01 00:00:00'"

# --- the given tables as the feed's tables ---------------------------------------

EV = """ev AS (
  SELECT event_id, ts AS "timestamp", user_id,
    concat(user_id, '_', CAST(floor(date_diff('day', date '2024-01-01', CAST(ts AS date)) / 7.0) AS int)) AS session_id,
    CASE event_type WHEN 'view' THEN 'impression' WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'save'
      WHEN 'error' THEN 'hide' WHEN 'signup' THEN 'feed_request' END AS event_type,
    CAST(json_extract_string(props, '$.k') AS int) AS item_id, value AS dwell_time, props AS metadata
  FROM events)"""

CT = """ct AS (
  SELECT CAST(p_partkey AS int) AS item_id, p_brand AS source,
    CASE WHEN p_size % 2 = 0 THEN 'rss' ELSE 'hackernews' END AS source_type, p_name AS title, p_type AS category,
    concat('/items/', p_partkey) AS url,
    timestamp '2023-12-01' + CAST(p_partkey % 1000 AS int) * interval '1' hour AS published_at
  FROM part)"""

IM = """im AS (
  SELECT e.event_id, e."timestamp" AS impression_time, e.user_id, e.session_id, e.item_id,
    CAST(e.event_type = 'click' AS int) AS clicked,
    CAST(row_number() OVER (PARTITION BY e.session_id ORDER BY e."timestamp", e.event_id) AS int) AS rank_position,
    c.source, c.source_type, c.category,
    (epoch_us(e."timestamp") - epoch_us(c.published_at)) / 3.6e9 AS age_hours
  FROM ev e LEFT JOIN ct c ON e.item_id = c.item_id WHERE e.event_type IN ('impression', 'click'))"""

LG = """lg AS (
  SELECT concat(l_orderkey, '-', CAST(round(l_extendedprice * 100) AS bigint)) AS event_id, l_orderkey AS session_id,
    o_custkey AS user_id, l_partkey AS item_id, l_linenumber AS rank_position,
    CAST(l_returnflag = 'R' AS int) AS clicked, l_shipdate AS impression_time, p_brand AS source, p_type AS category,
    (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9 AS raw_age_hours,
    greatest((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9, 0.0) AS age_hours, l_extendedprice AS score
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

PR = """pr AS (
  SELECT b AS batch, page_id, url,
    regexp_extract(html, '<title>(.*?)</title>', 1) || CASE WHEN b = 2 THEN ' (v2)' ELSE '' END AS title
  FROM pages, (VALUES (1), (2)) v(b)),
rec AS (
  SELECT (batch - 1) * 1000000000000 + page_id AS arrival, concat('rss_', md5(concat(url, '|', title))) AS item_id,
    regexp_extract(url, '^https?://([^/]+)', 1) AS source, 'rss' AS source_type, title, url,
    timestamp '2024-01-01' + CAST(page_id AS int) * interval '1' hour AS published_at,
    regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS category
  FROM pr),
pg1 AS (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY url ORDER BY arrival) = 1),
pg AS (SELECT *, '' AS description, CAST(length(title || ' ' || '') AS int) AS content_length
  FROM pg1 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY arrival) = 1)"""

# --- priors and point in time ------------------------------------------------------

UH = """uh AS (
  SELECT user_id, impression_time AS feature_timestamp, event_id,
    coalesce(sum(clicked) OVER w, 0) AS user_prev_clicks, count(*) OVER w AS user_prev_impressions,
    coalesce(coalesce(sum(clicked) OVER w, 0) / nullif(count(*) OVER w, 0), 0.0) AS user_ctr_prior,
    coalesce(lag(coalesce(category, 'unknown')) OVER o, 'unknown') AS user_prev_category,
    coalesce(lag(coalesce(source, 'unknown')) OVER o, 'unknown') AS user_prev_source
  FROM im WINDOW o AS (PARTITION BY user_id ORDER BY impression_time, event_id),
    w AS (PARTITION BY user_id ORDER BY impression_time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""

IH = """ih AS (
  SELECT item_id, impression_time AS feature_timestamp, event_id,
    coalesce(sum(clicked) OVER w, 0) AS item_prev_clicks, count(*) OVER w AS item_prev_impressions,
    coalesce(coalesce(sum(clicked) OVER w, 0) / nullif(count(*) OVER w, 0), 0.0) AS item_ctr_prior
  FROM im WINDOW w AS (PARTITION BY item_id ORDER BY impression_time, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""

TR = """tr0 AS (
  SELECT im.*, u.user_prev_clicks, u.user_prev_impressions, u.user_ctr_prior, u.user_prev_category, u.user_prev_source,
    u.feature_timestamp AS user_feature_time
  FROM im ASOF LEFT JOIN uh u ON im.user_id = u.user_id AND im.impression_time >= u.feature_timestamp),
tr AS (
  SELECT t.* REPLACE (coalesce(t.source, 'unknown') AS source, coalesce(t.category, 'unknown') AS category),
    i.item_prev_impressions, i.item_prev_clicks, i.item_ctr_prior, i.feature_timestamp AS item_feature_time,
    greatest(coalesce(t.age_hours, 0.0), 0.0) AS item_age_hours,
    CAST(coalesce(t.category, 'unknown') = t.user_prev_category AS int) AS user_item_category_match_v2,
    CAST(coalesce(t.source, 'unknown') = t.user_prev_source AS int) AS user_item_source_match_v2,
    1.0 / (1.0 + greatest(coalesce(t.age_hours, 0.0), 0.0)) AS recency_decay
  FROM tr0 t ASOF LEFT JOIN ih i ON t.item_id = i.item_id AND t.impression_time >= i.feature_timestamp)"""

VEC = """iv AS (SELECT CAST(vec_id AS int) AS item_id, CAST(embedding AS double[]) AS v FROM embeddings),
uvd AS (
  SELECT im.user_id, d.i AS dim, avg(coalesce(iv.v[d.i], 0.0)) AS value
  FROM im LEFT JOIN iv ON im.item_id = iv.item_id, (SELECT unnest(generate_series(1, 64)) AS i) d
  WHERE im.clicked = 1 GROUP BY 1, 2),
uv AS (SELECT user_id, list(value ORDER BY dim) AS u FROM uvd GROUP BY 1),
emb0 AS (
  SELECT tr.*, coalesce(list_dot_product(uv.u, iv.v), 0.0) AS dp,
    coalesce(sqrt(list_dot_product(uv.u, uv.u)), 0.0) AS user_embedding_norm,
    coalesce(sqrt(list_dot_product(iv.v, iv.v)), 0.0) AS item_embedding_norm
  FROM tr LEFT JOIN iv ON tr.item_id = iv.item_id LEFT JOIN uv ON tr.user_id = uv.user_id),
emb AS (
  SELECT *, dp / CASE WHEN user_embedding_norm * item_embedding_norm = 0 THEN 1e-12
    ELSE user_embedding_norm * item_embedding_norm END AS user_item_embedding_cosine FROM emb0)"""

# user profile (most clicked source and category) and the simulated-log priors on it
PF = """cl AS (SELECT e.user_id, c.source, c.category FROM ev e LEFT JOIN ct c ON e.item_id = c.item_id
  WHERE e.event_type = 'click'),
pcat AS (SELECT user_id, category AS preferred_category FROM (SELECT user_id, category, count(*) AS n FROM cl
  WHERE category IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category) = 1),
psrc AS (SELECT user_id, source AS preferred_source FROM (SELECT user_id, source, count(*) AS n FROM cl
  WHERE source IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, source) = 1)"""

SL = """sl AS (
  SELECT im.*, c.preferred_category, s.preferred_source,
    CAST(coalesce(im.category, 'unknown') = coalesce(c.preferred_category, 'unknown') AS int) AS preferred_category_match,
    CAST(coalesce(im.source, 'unknown') = coalesce(s.preferred_source, 'unknown') AS int) AS preferred_source_match,
    1.0 / (1.0 + greatest(coalesce(im.age_hours, 0.0), 0.0)) AS recency_decay_sim
  FROM im LEFT JOIN pcat c ON im.user_id = c.user_id LEFT JOIN psrc s ON im.user_id = s.user_id)"""

PL = """ps AS (
  SELECT sl.*, i.item_ctr_prior AS ictr, u.user_ctr_prior AS uctr
  FROM sl JOIN uh u ON sl.event_id = u.event_id JOIN ih i ON sl.event_id = i.event_id),
sc AS (
  SELECT *, 1.8 * ictr + 0.8 * uctr + 0.7 * recency_decay_sim + 0.8 * preferred_category_match
      + 0.5 * preferred_source_match + 1.0 * (1.0 / greatest(rank_position, 1)) AS logged_policy_score,
    1.2 * ictr + 0.6 * uctr + 1.2 * recency_decay_sim + 1.0 * preferred_category_match
      + 0.7 * preferred_source_match + 0.6 * (1.0 / greatest(rank_position, 1)) AS target_policy_score
  FROM ps),
mx AS (SELECT *, exp(logged_policy_score - max(logged_policy_score) OVER (PARTITION BY session_id)) AS le,
    exp(target_policy_score - max(target_policy_score) OVER (PARTITION BY session_id)) AS te FROM sc),
pol AS (SELECT *, le / sum(le) OVER (PARTITION BY session_id) AS logged_propensity,
    te / sum(te) OVER (PARTITION BY session_id) AS target_propensity FROM mx)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


E_BASE = (EV, CT, IM)
E_TRAIN = (*E_BASE, UH, IH, TR)
E_POLICY = (*E_BASE, UH, IH, PF, SL, PL)

ITEM_BASE = """st AS (
  SELECT item_id, sum(clicked) AS clicks, count(*) AS shown, max(impression_time) AS last_seen_time,
    arg_max(source, (impression_time, event_id)) AS source, arg_max(category, (impression_time, event_id)) AS category
  FROM {log} GROUP BY item_id)"""


def _attribute_list(log: str, attribute: str, k: int) -> str:
    return f"""SELECT key, item_id, last_seen_time, source, category, '{attribute}_match' AS retrieval_strategy,
    CAST(clicks AS double) AS retrieval_score FROM (
    SELECT {attribute} AS key, item_id, sum(clicked) AS clicks, count(*) AS shown, max(impression_time) AS last_seen_time,
      arg_max(source, (impression_time, event_id)) AS source, arg_max(category, (impression_time, event_id)) AS category
    FROM {log} WHERE {attribute} IS NOT NULL GROUP BY {attribute}, item_id)
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY clicks DESC, shown DESC, last_seen_time DESC, item_id) <= {k}"""


def _popular(k: int) -> str:
    return f"""SELECT item_id, last_seen_time, source, category, 'popular' AS retrieval_strategy,
    CAST(clicks AS double) AS retrieval_score FROM st ORDER BY clicks DESC, shown DESC, last_seen_time DESC, item_id LIMIT {k}"""


def _recent(k: int) -> str:
    return f"""SELECT item_id, last_seen_time, source, category, 'recent' AS retrieval_strategy,
    CAST(count(*) OVER () - row_number() OVER (ORDER BY last_seen_time DESC, item_id) + 1 AS double) AS retrieval_score
  FROM (SELECT * FROM st ORDER BY last_seen_time DESC, item_id LIMIT {k})"""


def _unseen(k: int) -> str:
    return f"""SELECT user_id, item_id, last_seen_time, source, category, 'unseen_recent' AS retrieval_strategy,
    CAST(count(*) OVER (PARTITION BY user_id) - rn + 1 AS double) AS retrieval_score FROM (
    SELECT u.user_id, st.*, row_number() OVER (PARTITION BY u.user_id ORDER BY last_seen_time DESC, st.item_id) AS rn
    FROM (SELECT DISTINCT user_id FROM im) u, st
    WHERE NOT EXISTS (SELECT 1 FROM im s WHERE s.user_id = u.user_id AND s.item_id = st.item_id)
    QUALIFY rn <= {k})"""


PREFS = """uc AS (SELECT user_id, category FROM (SELECT user_id, category, count(*) AS n FROM im WHERE category IS NOT NULL
  GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category) = 1),
us AS (SELECT user_id, source FROM (SELECT user_id, source, count(*) AS n FROM im WHERE source IS NOT NULL
  GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, source) = 1),
pf AS (SELECT u.user_id, uc.category AS preferred_category, us.source AS preferred_source
  FROM (SELECT DISTINCT user_id FROM im) u LEFT JOIN uc ON u.user_id = uc.user_id LEFT JOIN us ON u.user_id = us.user_id)"""


def _blended(each: int, final: int) -> str:
    return f"""{ITEM_BASE.format(log='im')}, {PREFS},
pop AS ({_popular(each)}),
rcn AS ({_recent(each)}),
uns AS ({_unseen(each)}),
cat AS ({_attribute_list('im', 'category', each)}),
src AS ({_attribute_list('im', 'source', each)}),
cand AS (
  SELECT user_id, pop.*, 0 AS place, 1.00 AS weight FROM pf, pop
  UNION ALL SELECT user_id, rcn.*, 1, 0.90 FROM pf, rcn
  UNION ALL SELECT uns.*, 2, 0.95 FROM uns
  UNION ALL SELECT user_id, item_id, last_seen_time, source, category, retrieval_strategy, retrieval_score, 3, 1.10
    FROM pf JOIN cat ON pf.preferred_category = cat.key
  UNION ALL SELECT user_id, item_id, last_seen_time, source, category, retrieval_strategy, retrieval_score, 4, 1.05
    FROM pf JOIN src ON pf.preferred_source = src.key),
bl0 AS (
  SELECT user_id, item_id, max(retrieval_score * CAST(weight AS double)) AS blended_retrieval_score,
    max(retrieval_score) AS retrieval_score_raw, max(last_seen_time) AS last_seen_time,
    arg_max(source, place) AS source, arg_max(category, place) AS category,
    count(DISTINCT retrieval_strategy) AS retrieval_strategy_count
  FROM cand GROUP BY 1, 2),
bl AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY retrieval_strategy_count DESC,
    blended_retrieval_score DESC, last_seen_time DESC, item_id) AS int) AS retrieval_rank
  FROM bl0 QUALIFY retrieval_rank <= {final})"""


def _blended_each() -> str:
    """As ``_blended``, with lists and slates as long as each user's limit asks for, 50 at most."""
    at = "row_number() OVER ({}ORDER BY clicks DESC, shown DESC, last_seen_time DESC, item_id) AS pos"
    lists = "".join(
        f""",
{name} AS (SELECT *, {at.format('PARTITION BY key ')} FROM (
  SELECT {column} AS key, item_id, sum(clicked) AS clicks, count(*) AS shown, max(impression_time) AS last_seen_time,
    arg_max(source, (impression_time, event_id)) AS source, arg_max(category, (impression_time, event_id)) AS category
  FROM im WHERE {column} IS NOT NULL GROUP BY 1, 2))"""
        for name, column in (("cat", "category"), ("src", "source"))
    )
    return f"""{ITEM_BASE.format(log='im')}, {PREFS},
lim AS (SELECT pf.*, CAST(user_id % 60 - 4 AS int) AS "limit", greatest(10, 2 * (user_id % 60 - 4)) AS each_k,
  greatest(20, 3 * (user_id % 60 - 4)) AS final_k FROM pf WHERE user_id % 60 - 4 BETWEEN 1 AND 50),
pop AS (SELECT *, {at.format('')} FROM st),
rcn AS (SELECT *, row_number() OVER (ORDER BY last_seen_time DESC, item_id) AS pos, count(*) OVER () AS n FROM st),
uns AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM (
  SELECT u.user_id, st.*, row_number() OVER (PARTITION BY u.user_id ORDER BY last_seen_time DESC, st.item_id) AS pos
  FROM lim u, st WHERE NOT EXISTS (SELECT 1 FROM im s WHERE s.user_id = u.user_id AND s.item_id = st.item_id))){lists},
cand AS (
  SELECT user_id, item_id, last_seen_time, source, category, CAST(clicks AS double) AS score, 0 AS place, 1.00 AS weight FROM lim, pop WHERE pos <= each_k
  UNION ALL SELECT user_id, item_id, last_seen_time, source, category, CAST(least(n, each_k) - pos + 1 AS double), 1, 0.90 FROM lim, rcn WHERE pos <= each_k
  UNION ALL SELECT user_id, item_id, last_seen_time, source, category, CAST(least(n, each_k) - pos + 1 AS double), 2, 0.95 FROM lim JOIN uns USING (user_id) WHERE pos <= each_k
  UNION ALL SELECT user_id, item_id, last_seen_time, source, category, CAST(clicks AS double), 3, 1.10 FROM lim JOIN cat ON preferred_category = key WHERE pos <= each_k
  UNION ALL SELECT user_id, item_id, last_seen_time, source, category, CAST(clicks AS double), 4, 1.05 FROM lim JOIN src ON preferred_source = key WHERE pos <= each_k),
bl0 AS (
  SELECT user_id, item_id, max(score * CAST(weight AS double)) AS blended_retrieval_score, max(last_seen_time) AS last_seen_time,
    arg_max(source, place) AS source, arg_max(category, place) AS category, count(DISTINCT place) AS strategies
  FROM cand GROUP BY 1, 2),
bl AS (
  SELECT bl0.* FROM bl0 JOIN lim USING (user_id)
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY strategies DESC, blended_retrieval_score DESC, bl0.last_seen_time DESC, item_id) <= final_k)"""


def _greedy(slate: str, tie: str, k: int, wc: float, ws: float, tie_type: str, slate_type: str) -> str:
    """Recursive greedy picks over CTE pool(slate, tie, category, source, score)."""
    cp = f"{wc} * len(list_filter(g.cats, lambda x: x = p.category))"
    sp = f"{ws} * len(list_filter(g.srcs, lambda x: x = p.source))"
    return f"""g(slate, step, tie, cp, sp, fs, ids, cats, srcs) AS (
  SELECT slate, 0, CAST(NULL AS {tie_type}), CAST(NULL AS double), CAST(NULL AS double), CAST(NULL AS double),
    CAST([] AS {tie_type}[]), CAST([] AS varchar[]), CAST([] AS varchar[]) FROM (SELECT DISTINCT slate FROM pool)
  UNION ALL
  SELECT slate, step, tie, cp, sp, fs, list_append(ids, tie), list_append(cats, category), list_append(srcs, source) FROM (
    SELECT *, row_number() OVER (PARTITION BY slate ORDER BY fs DESC, score DESC, tie) AS rn FROM (
      SELECT g.slate, g.step + 1 AS step, p.tie, CAST({cp} AS double) AS cp, CAST({sp} AS double) AS sp,
        p.score - CAST({cp} AS double) - CAST({sp} AS double) AS fs, p.score, g.ids, g.cats, g.srcs, p.category, p.source
      FROM g JOIN pool p ON p.slate = g.slate WHERE g.step < {k} AND NOT list_contains(g.ids, p.tie))) WHERE rn = 1)"""


ORACLE: dict[str, str] = {}


def _r(*names: str, suffix: str = "") -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


# --- content -----------------------------------------------------------------------

ORACLE["content_normalized"] = with_(PR) + (
    "SELECT item_id, source, source_type, title, description, url, published_at, category, content_length FROM pg"
)
ORACLE["content_newest"] = with_(PR) + (
    "SELECT item_id, title, source, category, published_at, url FROM pg WHERE trim(title) <> '' "
    "ORDER BY published_at DESC NULLS LAST, item_id LIMIT 50"
)
ORACLE["item_features"] = with_(PR) + f""", d AS (
  SELECT * REPLACE (CASE WHEN source NOT LIKE 'm.%' THEN published_at END AS published_at) FROM pg),
a AS (SELECT *, (epoch_us({PAGES_AS_OF}) - epoch_us(published_at)) / 3.6e9 AS age FROM d)
SELECT item_id, source, source_type, category, round(coalesce(age, (SELECT median(age) FROM a)), 6) AS age_hours,
  CAST(length(title) AS int) AS title_length, CAST(length(description) AS int) AS description_length,
  CAST(coalesce(hour(published_at), -1) AS int) AS hour_published,
  CAST(coalesce(isodow(published_at) - 1, -1) AS int) AS weekday_published,
  CAST(source_type = 'hackernews' AS int) AS is_hackernews, CAST(source_type = 'rss' AS int) AS is_rss FROM a""".replace(
    ", d AS", ",\nd AS", 1
)
ORACLE["ingest_stories"] = """WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '?') THEN 'comment' ELSE 'story' END AS type,
    regexp_extract(html, '<title>(.*?)</title>', 1) AS title, CASE WHEN contains(url, '#') THEN '' ELSE url END AS url,
    regexp_extract(url, '^https?://([^/]+)', 1) AS author,
    timestamp '2024-01-01' + CAST(page_id AS int) * interval '1' hour AS published_at FROM pages)
SELECT concat('hn_', page_id) AS item_id, 'hackernews' AS source, title, url, author, published_at, 'tech' AS category
FROM p WHERE type = 'story' AND url <> ''"""
ORACLE["ingest_editorial"] = """WITH p AS (
  SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
    regexp_extract(url, '^https?://([^/]+)', 1) AS author,
    regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS section FROM pages)
SELECT concat('guardian_news_', page_id) AS item_id, title, '' AS description, url, author,
  timestamp '2024-01-01' AS published_at, CASE WHEN section = '' THEN 'news' ELSE section END AS category FROM p"""
ORACLE["ingest_feed"] = """WITH p AS (
  SELECT concat('page ', page_id) AS title, url,
    CASE WHEN regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) = '' THEN 'other'
      ELSE regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) END AS source FROM pages)
SELECT concat('rss_', md5(concat(url, '|', title))) AS item_id, source, title, url,
  timestamp '2024-01-01 06:00:00' AS published_at, concat('cat_', source) AS category FROM p"""
ORACLE["event_append"] = with_(EV) + """SELECT CAST(event_id AS varchar) AS event_id, "timestamp",
  CAST(user_id AS varchar) AS user_id, session_id, event_type, CAST(item_id AS varchar) AS item_id,
  'v0_manual' AS model_version, 'manual_feed' AS policy_name, 'desktop' AS device_type, metadata, dwell_time FROM ev"""

# --- first-generation features ------------------------------------------------------

_CONTEXT = """CAST(hour("timestamp") AS int) AS hour_of_day, CAST(isodow("timestamp") - 1 AS int) AS weekday,
  CAST(isodow("timestamp") IN (6, 7) AS int) AS is_weekend"""
ORACLE["context_features"] = with_(EV) + f"SELECT event_id, {_CONTEXT} FROM ev WHERE event_type = 'impression'"
_PIVOT = """SELECT user_id, count(item_id) FILTER (event_type = 'impression') AS recent_impression_count,
  count(item_id) FILTER (event_type = 'click') AS recent_click_count,
  count(item_id) FILTER (event_type = 'save') AS recent_save_count,
  count(item_id) FILTER (event_type = 'hide') AS recent_hide_count FROM ev GROUP BY user_id"""
ORACLE["user_event_pivot"] = with_(EV) + _PIVOT
_UF = f"""pv AS ({_PIVOT}),
uf AS (SELECT pv.*, coalesce(s.preferred_source, 'unknown') AS preferred_source,
  coalesce(c.preferred_category, 'unknown') AS preferred_category
  FROM pv LEFT JOIN psrc s ON pv.user_id = s.user_id LEFT JOIN pcat c ON pv.user_id = c.user_id)"""
ORACLE["user_preferences"] = with_(EV, CT, PF, _UF) + "SELECT * FROM uf"
_LABEL = """lb AS (
  SELECT e.event_id, e."timestamp", e.user_id, e.session_id, e.item_id, coalesce(c.clicked, 0) AS clicked FROM ev e
  LEFT JOIN (SELECT DISTINCT user_id, session_id, item_id, 1 AS clicked FROM ev WHERE event_type = 'click') c
    ON e.user_id = c.user_id AND e.session_id = c.session_id AND e.item_id = c.item_id
  WHERE e.event_type = 'impression')"""
ORACLE["labelled_impressions"] = with_(EV, _LABEL) + "SELECT * FROM lb"
_ITEMF = f"""itf AS (
  SELECT item_id, source, source_type, category, (epoch_us({AS_OF}) - epoch_us(published_at)) / 3.6e9 AS age_hours,
    CAST(length(title) AS int) AS title_length, 0 AS description_length, CAST(hour(published_at) AS int) AS hour_published,
    CAST(isodow(published_at) - 1 AS int) AS weekday_published,
    CAST(source_type = 'hackernews' AS int) AS is_hackernews, CAST(source_type = 'rss' AS int) AS is_rss FROM ct)"""
ORACLE["training_dataset"] = with_(EV, CT, PF, _UF, _LABEL, _ITEMF) + f"""SELECT lb.*,
  i.* EXCLUDE (item_id) REPLACE (round(i.age_hours, 6) AS age_hours),
  coalesce(u.recent_impression_count, 0) AS recent_impression_count,
  coalesce(u.recent_click_count, 0) AS recent_click_count, coalesce(u.recent_save_count, 0) AS recent_save_count,
  coalesce(u.recent_hide_count, 0) AS recent_hide_count, u.preferred_source, u.preferred_category, {_CONTEXT},
  CAST(coalesce(i.source, 'unknown') = coalesce(u.preferred_source, 'unknown') AS int) AS preferred_source_match,
  CAST(coalesce(i.category, 'unknown') = coalesce(u.preferred_category, 'unknown') AS int) AS preferred_category_match
FROM lb LEFT JOIN itf i ON lb.item_id = i.item_id LEFT JOIN uf u ON lb.user_id = u.user_id"""
ORACLE["session_running_counts"] = with_(EV) + """SELECT event_id,
  count(*) FILTER (event_type = 'impression') OVER w AS recent_impression_count,
  count(*) FILTER (event_type = 'click') OVER w AS recent_click_count,
  count(*) FILTER (event_type = 'save') OVER w AS recent_save_count,
  count(*) FILTER (event_type = 'hide') OVER w AS recent_hide_count
FROM ev WINDOW w AS (PARTITION BY session_id ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
ORACLE["session_depth"] = with_(EV) + (
    'SELECT event_id, row_number() OVER (PARTITION BY session_id ORDER BY "timestamp", event_id) AS session_depth FROM ev'
)
ORACLE["user_rolling_24h"] = with_(EV) + """SELECT event_id,
  count(*) FILTER (event_type = 'click') OVER w AS recent_click_count_24h,
  count(*) FILTER (event_type = 'impression') OVER w AS recent_impression_count_24h
FROM (SELECT *, epoch_us("timestamp") // 1000000 AS s FROM ev)
WINDOW w AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING)"""
ORACLE["item_popularity_7d"] = with_(EV) + """SELECT event_id,
  count(*) FILTER (event_type = 'click') OVER w AS recent_popularity
FROM (SELECT *, epoch_us("timestamp") // 1000000 AS s FROM ev)
WINDOW w AS (PARTITION BY item_id ORDER BY s RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING)"""
ORACLE["user_average_dwell"] = with_(EV) + """SELECT event_id, round(avg(dwell_time) OVER w + 1e-9, 6) AS avg_dwell_time FROM ev
WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
ORACLE["global_ctr"] = with_(EV) + """SELECT event_id, coalesce(count(*) FILTER (event_type = 'click') OVER w
  / nullif(count(*) FILTER (event_type = 'impression') OVER w, 0), 0.0) AS global_ctr FROM ev
WINDOW w AS (ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


_PREF7 = """clk AS (SELECT {user} AS user_id, epoch_us("timestamp") // 1000000 AS s, c.source, c.category
  FROM ev e LEFT JOIN ct c ON e.item_id = c.item_id WHERE e.event_type = 'click'),
seen AS (SELECT event_id, {user} AS user_id, epoch_us("timestamp") // 1000000 AS s FROM ev WHERE event_type = 'impression'),
near AS (SELECT i.event_id, c.source, c.category FROM seen i JOIN clk c ON c.user_id = i.user_id AND c.s BETWEEN i.s - 604800 AND i.s - 1),
by_category AS (SELECT event_id, category FROM near WHERE category IS NOT NULL GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY count(*) DESC, category) = 1),
by_source AS (SELECT event_id, source FROM near WHERE source IS NOT NULL GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY count(*) DESC, source) = 1)
SELECT event_id, coalesce(category, 'unknown') AS preferred_category_last_7d, coalesce(source, 'unknown') AS preferred_source_last_7d
FROM seen LEFT JOIN by_category USING (event_id) LEFT JOIN by_source USING (event_id)"""
ORACLE["pref_category_7d"] = with_(EV, CT, _PREF7.format(user="user_id"))
ORACLE["pref_category_7d_one_user"] = with_(EV, CT, _PREF7.format(user="0"))

# --- backbone, priors, point in time ---------------------------------------------------

ORACLE["impressions_backbone"] = with_(LG) + """SELECT event_id AS impression_id, user_id, session_id, item_id,
  impression_time, clicked, rank_position, 'unknown' AS model_version, 'unknown' AS policy_name, source,
  'unknown' AS source_type, category, CAST(hour(impression_time) AS int) AS hour,
  CAST(isodow(impression_time) - 1 AS int) AS day_of_week, CAST(isodow(impression_time) IN (6, 7) AS int) AS is_weekend,
  age_hours AS item_age_hours FROM lg"""
ORACLE["impressions_numbered"] = with_(LG) + """SELECT event_id AS row_key,
  CAST(row_number() OVER (ORDER BY impression_time, event_id) AS varchar) AS impression_id FROM lg"""
ORACLE["impressions_numbered_ranges"] = ORACLE["impressions_numbered"]
ORACLE["item_prior_ctr_ranges"] = with_(LG) + """SELECT event_id, CAST(clicks AS bigint) AS item_prev_clicks, shown AS item_prev_impressions,
  coalesce(clicks / nullif(shown, 0), 0.0) AS item_ctr_prior
FROM (SELECT event_id, coalesce(sum(clicked) OVER w, 0) AS clicks, count(*) OVER w AS shown FROM lg
  WINDOW w AS (ORDER BY impression_time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
ORACLE["user_prior_ctr"] = with_(*E_BASE, UH) + (
    "SELECT event_id, user_id, CAST(user_prev_clicks AS bigint) AS user_prev_clicks, user_prev_impressions, "
    "round(user_ctr_prior, 6) AS user_ctr_prior FROM uh"
)
ORACLE["item_prior_ctr"] = with_(LG, IH.replace("FROM im", "FROM lg")) + (
    "SELECT event_id, item_id, CAST(item_prev_clicks AS bigint) AS item_prev_clicks, item_prev_impressions, "
    "round(item_ctr_prior, 6) AS item_ctr_prior FROM ih"
)
ORACLE["user_prev_attrs"] = with_(*E_BASE, UH) + "SELECT event_id, user_prev_category, user_prev_source FROM uh"
ORACLE["pit_user_join"] = with_(*E_BASE, UH) + """SELECT e.event_id, e.user_id, e."timestamp",
  CAST(u.user_prev_clicks AS bigint) AS user_prev_clicks, u.user_prev_impressions,
  round(u.user_ctr_prior, 6) AS user_ctr_prior, u.user_prev_category, u.feature_timestamp AS user_feature_time
FROM (SELECT * FROM ev WHERE event_type IN ('save', 'hide')) e
ASOF LEFT JOIN uh u ON e.user_id = u.user_id AND e."timestamp" > u.feature_timestamp"""
ORACLE["pit_user_join_ranges"] = with_(EV) + """, clicks AS (
  SELECT date_trunc('day', "timestamp") AS click_time, event_id AS click_id, item_id FROM ev WHERE event_type = 'click'
  QUALIFY row_number() OVER (PARTITION BY date_trunc('day', "timestamp") ORDER BY event_id DESC) = 1
)
SELECT e.event_id, 'all' AS user_id, date_trunc('day', e."timestamp") AS "timestamp", click_id, c.item_id, click_time AS found_at
FROM (SELECT * FROM ev WHERE event_type IN ('save', 'hide')) e
ASOF LEFT JOIN clicks c ON date_trunc('day', e."timestamp") >= c.click_time"""
ORACLE["pit_training_rows"] = with_(*E_TRAIN) + """SELECT event_id, CAST(user_prev_clicks AS double) AS user_prev_clicks,
  CAST(user_prev_impressions AS double) AS user_prev_impressions, round(user_ctr_prior, 6) AS user_ctr_prior,
  user_prev_category, user_prev_source, user_feature_time, CAST(item_prev_impressions AS double) AS item_prev_impressions,
  CAST(item_prev_clicks AS double) AS item_prev_clicks, round(item_ctr_prior, 6) AS item_ctr_prior, item_feature_time,
  user_item_category_match_v2, user_item_source_match_v2, round(recency_decay, 6) AS recency_decay FROM tr"""
ORACLE["temporal_validity"] = with_(*E_TRAIN) + """SELECT count(*) AS total_rows,
  count(*) FILTER (user_feature_time > impression_time) AS future_user_features,
  count(*) FILTER (item_feature_time > impression_time) AS future_item_features,
  count(*) FILTER (item_age_hours < 0) AS negative_ages, count(*) FILTER (clicked = 1) AS clicked_rows,
  count(*) FILTER (clicked = 0) AS not_clicked_rows FROM tr"""
ORACLE["sim_priors"] = with_(*E_BASE, UH, IH) + """SELECT im.event_id,
  CAST(u.user_prev_clicks AS bigint) AS user_prev_clicks_sim, u.user_prev_impressions AS user_prev_impressions_sim,
  CAST(i.item_prev_clicks AS bigint) AS item_prev_clicks_sim, i.item_prev_impressions AS item_prev_impressions_sim,
  round(u.user_ctr_prior, 6) AS user_ctr_prior_sim, round(i.item_ctr_prior, 6) AS item_ctr_prior_sim,
  round(1.0 / (1.0 + greatest(coalesce(im.age_hours, 0.0), 0.0)), 6) AS recency_decay_sim
FROM im JOIN uh u ON im.event_id = u.event_id JOIN ih i ON im.event_id = i.event_id"""

# --- online ------------------------------------------------------------------------------

_LU = "lu AS (SELECT * FROM tr QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY impression_time DESC, event_id DESC) = 1)"
_LI = "li AS (SELECT * FROM tr QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY impression_time DESC, event_id DESC) = 1)"
ORACLE["latest_user_snapshot"] = with_(*E_TRAIN, _LU) + """SELECT user_id, CAST(user_prev_clicks AS double) AS user_prev_clicks,
  CAST(user_prev_impressions AS double) AS user_prev_impressions, round(user_ctr_prior, 6) AS user_ctr_prior,
  user_prev_category, user_prev_source, impression_time AS feature_timestamp FROM lu"""
ORACLE["latest_item_snapshot"] = with_(*E_BASE, IH) + """SELECT im.item_id, CAST(i.item_prev_clicks AS bigint) AS item_prev_clicks,
  i.item_prev_impressions, round(i.item_ctr_prior, 6) AS item_ctr_prior, round(im.age_hours, 6) AS item_age_hours,
  im.source, im.category, im.impression_time AS feature_timestamp
FROM im JOIN ih i ON im.event_id = i.event_id
QUALIFY row_number() OVER (PARTITION BY im.item_id ORDER BY im.impression_time DESC, im.event_id DESC) = 1"""
ORACLE["online_status"] = with_(*E_BASE) + """SELECT count(DISTINCT user_id) AS user_count,
  count(DISTINCT item_id) AS item_count, 'training rows' AS source_dataset FROM im"""
ORACLE["online_lookup"] = with_(*E_TRAIN, _LU) + """SELECT CAST(c_custkey AS varchar) AS entity_id,
  CAST(lu.user_prev_clicks AS double) AS user_prev_clicks, lu.user_prev_category
FROM customer LEFT JOIN lu ON c_custkey = lu.user_id"""
ORACLE["online_overlay"] = with_(*E_TRAIN, _LU, _LI) + """SELECT tr.event_id, CAST(lu.user_prev_clicks AS double) AS user_prev_clicks,
  CAST(li.item_prev_clicks AS double) AS item_prev_clicks, round(li.item_ctr_prior, 6) AS item_ctr_prior,
  CAST(li.category = lu.user_prev_category AS int) AS preferred_category_match,
  CAST(li.source = lu.user_prev_source AS int) AS user_item_source_match_v2, round(li.recency_decay, 6) AS recency_decay
FROM tr JOIN lu ON tr.user_id = lu.user_id JOIN li ON tr.item_id = li.item_id"""

# --- vectors and text ----------------------------------------------------------------------

ORACLE["user_embeddings"] = with_(*E_BASE, VEC.split(",\nuv AS")[0]) + (
    "SELECT user_id, CAST(dim - 1 AS int) AS dim, round(value, 6) AS value FROM uvd"
)
ORACLE["similarity_features"] = with_(*E_TRAIN, VEC) + """SELECT event_id,
  round(user_item_embedding_cosine, 6) AS user_item_embedding_cosine, round(user_embedding_norm, 6) AS user_embedding_norm,
  round(item_embedding_norm, 6) AS item_embedding_norm,
  CASE WHEN user_item_embedding_cosine <= 0.2 THEN 'low' WHEN user_item_embedding_cosine <= 0.5 THEN 'medium'
    WHEN user_item_embedding_cosine <= 0.8 THEN 'high' ELSE 'very_high' END AS embedding_affinity_bucket FROM emb"""
ORACLE["pseudo_text"] = with_(*E_BASE) + """SELECT item_id, concat_ws(' ', coalesce(source, 'unknown'),
  coalesce(source_type, 'unknown'), coalesce(category, 'unknown')) AS embedding_text
FROM im QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY impression_time DESC, event_id DESC) = 1"""
_TFIDF = r"""WITH tk AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS t FROM documents),
tm AS (SELECT doc_id, unnest(t) AS term FROM tk UNION ALL
  SELECT doc_id, unnest(list_transform(generate_series(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1])) FROM tk),
vc AS (SELECT term FROM tm GROUP BY term ORDER BY count(*) DESC, term LIMIT 500),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tm WHERE term IN (SELECT term FROM vc) GROUP BY 1, 2),
w AS (SELECT tf.doc_id, tf.term, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*) OVER (PARTITION BY term))) + 1.0) AS w FROM tf)
SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w"""
ORACLE["tfidf_terms"] = f"SELECT doc_id, term, round(weight, 6) AS weight FROM ({_TFIDF})"
ORACLE["item_svd_gram"] = f"""WITH t AS ({_TFIDF.replace("LIMIT 500", "LIMIT 16")})
SELECT d.doc_id, round(coalesce((SELECT sum(a.weight * a.weight) FROM t a WHERE a.doc_id = d.doc_id), 0.0), 6) AS squared_length,
  round(coalesce((SELECT sum(a.weight * b.weight) FROM t a JOIN t b ON a.term = b.term AND b.doc_id = a.doc_id + 1
    WHERE a.doc_id = d.doc_id), 0.0), 6) AS next_product
FROM documents d"""

# --- retrieval --------------------------------------------------------------------------------

_L_STATS = (LG, ITEM_BASE.format(log="lg"))
ORACLE["cand_popular"] = with_(*_L_STATS) + _popular(20)
ORACLE["cand_recent"] = with_(*_L_STATS) + _recent(20)
ORACLE["cand_category"] = with_(LG) + _attribute_list("lg", "category", 20)
ORACLE["cand_source"] = with_(LG) + _attribute_list("lg", "source", 20)
ORACLE["cand_unseen"] = with_(*E_BASE, ITEM_BASE.format(log="im")) + _unseen(20)
ORACLE["cand_preferences"] = with_(*E_BASE, PREFS) + "SELECT * FROM pf"
ORACLE["cand_blended"] = with_(*E_BASE, _blended(10, 25)) + """SELECT user_id, item_id,
  round(blended_retrieval_score, 6) AS blended_retrieval_score, retrieval_score_raw, retrieval_strategy_count,
  last_seen_time, source, category, retrieval_rank FROM bl"""


def _value_counts(source: str, columns: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS varchar) AS value, count(*) AS n FROM {source} GROUP BY {c}" for c in columns
    )
    return (
        f"SELECT * FROM ({parts}) QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value NULLS FIRST) <= 10"
    )


ORACLE["candidates_per_user"] = with_(*E_BASE, _blended(10, 25)) + "SELECT user_id, count(item_id) AS candidates FROM bl GROUP BY user_id"
ORACLE["candidate_profile"] = with_(*E_BASE, _blended(10, 25)) + _value_counts(
    "bl", ["category", "source", "retrieval_strategy_count"]
)

# --- scoring, reranking, feeds ---------------------------------------------------------------------

_HEUR = """0.35 * item_ctr_prior + 0.20 * user_ctr_prior + 0.15 * recency_decay
    + 0.10 * CAST({c} AS double) + 0.10 * CAST({s} AS double) + 0.10 * user_item_embedding_cosine"""
ORACLE["heuristic_scores"] = with_(*E_TRAIN, VEC) + (
    "SELECT event_id, round("
    + _HEUR.format(c="user_item_category_match_v2", s="user_item_source_match_v2")
    + ", 6) AS model_score FROM emb"
)
ORACLE["rerank_freshness_diversity"] = (
    "WITH RECURSIVE "
    + ",\n".join(
        [
            LG,
            """a0 AS (SELECT *, CASE WHEN category <> 'PROMO' THEN age_hours END AS age FROM lg),
a1 AS (SELECT *, 0.15 * exp(-greatest(coalesce(age, median(age) OVER (PARTITION BY session_id)), 0.0) / 24.0) AS fb FROM a0),
pool AS (SELECT session_id AS slate, event_id AS tie, category, source, fb,
  score / 99991.0 + 1.0 * coalesce(fb, 0.0) AS score FROM a1)""",
            _greedy("slate", "tie", 5, 0.08, 0.10, "varchar", "bigint"),
        ]
    )
    + """ SELECT g.slate AS session_id, g.tie AS item_id, round(p.fb, 6) AS freshness_bonus,
  round(g.cp, 6) AS category_repeat_penalty, round(g.sp, 6) AS source_repeat_penalty, round(g.fs, 6) AS final_score,
  CAST(g.step AS int) AS final_rank FROM g JOIN pool p ON g.slate = p.slate AND g.tie = p.tie WHERE g.step > 0"""
)
ORACLE["rerank_retrieval_recency"] = (
    "WITH RECURSIVE "
    + ",\n".join(
        [
            LG,
            """pool AS (SELECT session_id AS slate, event_id AS tie, category, source,
  score / 99991.0 + 0.05 * rank_position + 0.20 * (1.0 / (1.0 + age_hours)) AS score FROM lg)""",
            _greedy("slate", "tie", 5, 0.05, 0.05, "varchar", "bigint"),
        ]
    )
    + """ SELECT slate AS session_id, tie AS item_id, round(fs, 6) AS final_score, CAST(step AS int) AS rank
FROM g WHERE step > 0"""
)
ORACLE["rerank_bad_scores"] = (
    "WITH RECURSIVE "
    + ",\n".join(
        [
            LG,
            """pool AS (SELECT session_id AS slate, event_id AS tie, category, source,
  CASE WHEN rank_position % 3 = 0 OR rank_position % 7 = 0 THEN 0.0
    ELSE score / 99991.0 + 0.05 * rank_position + 0.20 * (1.0 / (1.0 + age_hours)) END AS score FROM lg)""",
            _greedy("slate", "tie", 5, 0.05, 0.05, "varchar", "bigint"),
        ]
    )
    + """ SELECT slate AS session_id, tie AS item_id, round(fs, 6) AS final_score, CAST(step AS int) AS rank
FROM g WHERE step > 0"""
)


def _feed_v1(users: str, limit: int) -> str:
    """``users``: the user features of those the feed is built for."""
    return "WITH RECURSIVE " + ",\n".join(
        [
            EV,
            CT,
            PF,
            _UF,
            _ITEMF,
            f"""np AS (SELECT * FROM ct WHERE trim(title) <> '' ORDER BY published_at DESC, item_id LIMIT 50),
fr AS (SELECT u.*, n.item_id, n.title, n.source, n.source_type, n.category, n.url, i.age_hours, i.title_length,
    0.15 * exp(-greatest(i.age_hours, 0.0) / 24.0) AS freshness_bonus,
    1.0 / (1.0 + exp(-(-1.0 + 0.8 * CAST(n.category = u.preferred_category AS int) + 0.5 * CAST(n.source = u.preferred_source AS int)
      + 0.02 * i.title_length - 0.001 * i.age_hours + 0.01 * u.recent_click_count))) AS model_score
  FROM ({users}) u, np n JOIN itf i ON n.item_id = i.item_id),
pool AS (SELECT user_id AS slate, item_id AS tie, category, source, model_score + 1.0 * freshness_bonus AS score FROM fr)""",
            _greedy("slate", "tie", limit, 0.08, 0.10, "int", "bigint"),
        ]
    )


ORACLE["rank_feed_v1"] = _feed_v1("SELECT * FROM uf", 10) + """ SELECT f.user_id, 'fixed' AS model_version, f.item_id, f.title, f.source, f.source_type, f.category, f.url,
  round(f.model_score, 6) AS model_score, round(f.freshness_bonus, 6) AS freshness_bonus, CAST(g.step AS int) AS final_rank
FROM g JOIN fr f ON g.slate = f.user_id AND g.tie = f.item_id WHERE g.step > 0"""
ORACLE["rank_feed_requests"] = _feed_v1(
    """SELECT user_id, preferred_category, preferred_source, recent_click_count FROM uf
    UNION ALL SELECT user_id + 1000000, 'unknown', 'unknown', 0 FROM uf WHERE user_id % 50 = 0""",
    50,
) + """, asking AS (
  SELECT user_id, concat('r', user_id) AS session_id, CAST(user_id % 60 - 4 AS int) AS "limit"
  FROM (SELECT user_id FROM uf UNION ALL SELECT user_id + 1000000 FROM uf WHERE user_id % 50 = 0))
SELECT a.*, 'ok' AS status, f.item_id, round(f.model_score, 6) AS model_score, CAST(g.step AS int) AS final_rank
FROM asking a JOIN g ON g.slate = a.user_id JOIN fr f ON g.slate = f.user_id AND g.tie = f.item_id
WHERE a."limit" BETWEEN 1 AND 50 AND g.step BETWEEN 1 AND a."limit"
UNION ALL SELECT *, 'invalid limit', NULL, NULL, NULL FROM asking WHERE "limit" NOT BETWEEN 1 AND 50"""


def _feed_v2(user_row: str, blended: str = _blended(20, 30), most: int = 10, limit: str = "10") -> str:
    """``user_row``: which alias supplies the user's columns (item row offline, user row online)."""
    return (
        "WITH RECURSIVE "
        + ",\n".join(
            [
                *E_TRAIN,
                VEC,
                blended,
                _LU.replace("FROM tr", "FROM emb"),
                _LI.replace("FROM tr", "FROM emb"),
                f"""cf AS (SELECT b.user_id, b.item_id, b.source, b.category, b.blended_retrieval_score,
    li.item_ctr_prior, li.recency_decay, li.user_item_embedding_cosine, {user_row}.user_ctr_prior,
    CAST(b.category = {user_row}.user_prev_category AS int) AS cm, CAST(b.source = {user_row}.user_prev_source AS int) AS sm,
    CAST(count(*) OVER (PARTITION BY b.user_id) AS int) AS candidate_count
  FROM bl b JOIN li ON b.item_id = li.item_id JOIN lu ON b.user_id = lu.user_id),
cs AS (SELECT *, {_HEUR.format(c='cm', s='sm')} AS model_score FROM cf),
pool AS (SELECT user_id AS slate, item_id AS tie, category, source,
  model_score + 0.05 * blended_retrieval_score + 0.20 * recency_decay AS score FROM cs)""",
                _greedy("slate", "tie", most, 0.05, 0.05, "int", "bigint"),
            ]
        )
        + f""" SELECT c.user_id, c.candidate_count, CAST(least(c.candidate_count, {limit}) AS int) AS returned_count, c.item_id, c.source,
  c.category, round(c.blended_retrieval_score, 6) AS blended_retrieval_score, round(c.model_score, 6) AS model_score,
  round(g.fs, 6) AS final_score, CAST(g.step AS int) AS rank
FROM g JOIN cs c ON g.slate = c.user_id AND g.tie = c.item_id WHERE g.step > 0"""
    )


ORACLE["rank_feed_v2"] = _feed_v2("li")
ORACLE["rank_feed_requests_v2"] = (
    "SELECT * FROM (SELECT lim.session_id, lim.\"limit\", 'ok' AS status, f.* FROM ("
    + _feed_v2("li", _blended_each(), 50, "user_id % 60 - 4")
    + """) f JOIN (SELECT DISTINCT user_id, concat('r', user_id) AS session_id, CAST(user_id % 60 - 4 AS int) AS "limit" FROM events) lim USING (user_id)
WHERE f.rank <= lim."limit")
UNION ALL BY NAME SELECT DISTINCT user_id, concat('r', user_id) AS session_id, CAST(user_id % 60 - 4 AS int) AS "limit", 'invalid limit' AS status
FROM events WHERE event_type IN ('view', 'click') AND user_id % 60 - 4 NOT BETWEEN 1 AND 50"""
)
ORACLE["rank_feed_v2_online"] = _feed_v2("lu")

# --- policies and metrics ------------------------------------------------------------------------------

ORACLE["policy_scores"] = with_(*E_POLICY) + (
    "SELECT event_id, "
    + _r("logged_policy_score", "logged_propensity", "target_policy_score", "target_propensity")
    + " FROM pol"
)


def _logit(bias, cat, src, rec, pos, extra):
    return (
        f"1.0 / (1.0 + exp(-({bias} + {cat} * preferred_category_match + {src} * preferred_source_match "
        f"+ {rec} * recency_decay_sim + {pos} * (1.0 / greatest(rank_position, 1)) + {extra})))"
    )


ORACLE["click_probability"] = with_(*E_BASE, PF, SL) + (
    f"SELECT event_id, round({_logit(-2.6, 1.2, 0.7, 0.9, 1.1, '0.5 * 0.5 + 0.3 * 0.2')}, 6) AS click_probability, "
    f"round({_logit(-2.2, 1.0, 0.7, 1.2, 1.1, '0.0')}, 6) AS click_probability_v2 FROM sl"
)
ORACLE["weighted_slate"] = with_(*E_BASE, PF, SL) + """, nw AS (SELECT * FROM sl
  QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY impression_time DESC, event_id DESC) = 1),
wt AS (SELECT user_id, item_id, 1.0 + 1.8 * preferred_category_match + 1.0 * preferred_source_match
    + 0.3 * (1.0 / (1.0 + greatest(coalesce(age_hours, 24.0), 0.0))) + 0.25 * 0.5 + 0.4 * 0.2 AS weight,
    (CAST('0x' || substr(md5(concat_ws('|', '42', user_id, item_id)), 1, 8) AS bigint) + 0.5) / 4294967296.0 AS u FROM nw)
SELECT user_id, item_id, round(weight, 6) AS weight,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY -ln(u) / greatest(weight, 1e-6), item_id) AS int) AS rank_position
FROM wt QUALIFY rank_position <= 10""".replace(", nw", ",\nnw", 1)


def _ranking(source: str, score: str, name: str) -> str:
    return f"""{name}_r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY {score} DESC, event_id) AS rn,
  row_number() OVER (PARTITION BY session_id ORDER BY clicked DESC) AS ideal FROM {source}),
{name} AS (SELECT session_id, coalesce(sum(clicked) FILTER (rn <= 5), 0) / 5.0 AS precision_at_k,
  CASE WHEN sum(clicked) > 0 THEN coalesce(sum(clicked) FILTER (rn <= 5), 0) / sum(clicked) ELSE 0.0 END AS recall_at_k,
  CASE WHEN sum(clicked) > 0 THEN sum(clicked / log2(rn + 1)) FILTER (rn <= 5) / sum(clicked / log2(ideal + 1)) FILTER (ideal <= 5)
    ELSE 0.0 END AS ndcg_at_k FROM {name}_r GROUP BY session_id),
{name}_q AS (SELECT session_id, count(DISTINCT category) / count(*) AS category_diversity_at_k,
  count(DISTINCT source) / count(*) AS source_diversity_at_k,
  avg(1.0 / (1.0 + greatest(coalesce(age_hours, 0.0), 0.0))) AS freshness_at_k FROM {name}_r WHERE rn <= 5 GROUP BY session_id)"""


ORACLE["ranking_by_session"] = with_(LG, _ranking("lg", "score", "m")) + (
    "SELECT session_id, " + _r("precision_at_k", "recall_at_k", "ndcg_at_k") + " FROM m"
)
ORACLE["ranking_report"] = with_(LG, _ranking("lg", "score", "m")) + """SELECT count(*) AS sessions,
  round(avg(precision_at_k), 6) AS precision_at_k, round(avg(recall_at_k), 6) AS recall_at_k,
  round(avg(ndcg_at_k), 6) AS ndcg_at_k FROM m"""
ORACLE["feed_quality_report"] = with_(LG, _ranking("lg", "score", "m")) + """SELECT count(*) AS sessions,
  round(avg(category_diversity_at_k), 6) AS category_diversity_at_k,
  round(avg(source_diversity_at_k), 6) AS source_diversity_at_k, round(avg(freshness_at_k), 6) AS freshness_at_k FROM m_q"""
_METRICS = [("precision_at_k", ""), ("recall_at_k", ""), ("ndcg_at_k", "")] + [
    (m, "_q") for m in ("category_diversity_at_k", "source_diversity_at_k", "freshness_at_k")
]
ORACLE["policy_delta"] = with_(
    *E_POLICY, _ranking("pol", "logged_policy_score", "a"), _ranking("pol", "target_policy_score", "b")
) + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, round((SELECT avg({m}) FROM a{q}), 6) AS logged, round((SELECT avg({m}) FROM b{q}), 6) AS target, "
    f"round((SELECT avg({m}) FROM b{q}) - (SELECT avg({m}) FROM a{q}), 6) AS delta"
    for m, q in _METRICS
)
ORACLE["counterfactual_report"] = with_(*E_POLICY) + """SELECT count(*) AS n_rows, round(avg(clicked), 6) AS observed_ctr,
  round(avg(w * clicked), 6) AS ips_estimate, round(sum(w * clicked) / sum(w), 6) AS snips_estimate,
  round(avg(least(greatest(w, 0.0), 10.0) * clicked), 6) AS clipped_ips_estimate,
  round(avg(logged_propensity), 6) AS mean_logged_propensity, round(avg(target_propensity), 6) AS mean_target_propensity
FROM (SELECT *, target_propensity / greatest(logged_propensity, 1e-12) AS w FROM pol)"""
ORACLE["ips_single"] = with_(*E_POLICY) + """SELECT round(avg(clicked / logged_propensity), 6) AS ips,
  round(sum(clicked / logged_propensity) / sum(1.0 / logged_propensity), 6) AS snips FROM pol"""
_BINARY = """, p AS (SELECT clicked AS y, {p} AS p FROM lg),
r AS (SELECT y, p, rank() OVER (ORDER BY p) * 2 + count(*) OVER (PARTITION BY p) - 1 AS rk FROM p),
a AS (SELECT count(*) AS n, sum(y) AS np, CAST(sum(rk) FILTER (y = 1) AS bigint) AS sr, count(*) FILTER (p >= 0.5 AND y = 1) AS tp,
  count(*) FILTER (p >= 0.5 AND y = 0) AS fp FROM r)
SELECT n AS n_rows, (sr - np * (np + 1)) / (2.0::DOUBLE * np * (n - np)) AS auc,
  (tp + (n - np) - fp) / n AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, tp / np AS recall FROM a"""
ORACLE["binary_metrics"] = with_(LG) + _BINARY.format(p="score / 105000.0")
ORACLE["binary_metrics_crowded"] = with_(LG) + _BINARY.format(p="0.5::DOUBLE + score / 105000.0::DOUBLE * 1e-9::DOUBLE")



def _split(source: str, order: str) -> str:
    return f"""SELECT event_id, CASE WHEN rn <= floor(n * 0.70) THEN 'train' WHEN rn <= floor(n * 0.85) THEN 'val' ELSE 'test' END AS split
FROM (SELECT event_id, row_number() OVER (ORDER BY {order}) AS rn, count(*) OVER () AS n FROM {source})"""


ORACLE["split_time"] = with_(LG) + _split("lg", "impression_time, md5(event_id), event_id")
ORACLE["split_time_events"] = with_(EV) + _split("ev", '"timestamp", md5(CAST(event_id AS varchar)), event_id')
ORACLE["split_random"] = with_(LG) + """SELECT event_id, clicked, CASE WHEN rn <= floor(n * 0.7) THEN 'train' ELSE 'test' END AS split
FROM (SELECT event_id, clicked, count(*) OVER (PARTITION BY clicked) AS n,
  row_number() OVER (PARTITION BY clicked ORDER BY md5('42|' || event_id), event_id) AS rn FROM lg)"""

# --- checks ------------------------------------------------------------------------------------------------

ORACLE["quality_content"] = with_(PR) + """SELECT count(*) AS total_rows,
  count(*) FILTER (url IS NULL OR trim(url) = '') AS bad_urls,
  (SELECT count(*) FROM (SELECT url FROM rec GROUP BY url HAVING count(*) > 1)) AS duplicate_url_groups,
  count(*) FILTER (title IS NULL OR trim(title) = '') AS bad_titles FROM rec"""
ORACLE["content_by_source"] = with_(PR) + "SELECT source_type, source, count(*) AS n FROM pg GROUP BY 1, 2"
ORACLE["quality_events"] = with_(EV) + "SELECT user_id, event_type, count(*) AS n FROM ev GROUP BY 1, 2"
ORACLE["event_types"] = with_(EV) + "SELECT event_type, count(*) AS n FROM ev GROUP BY 1"
ORACLE["newest_events"] = with_(EV) + """SELECT "timestamp", user_id, session_id, event_type, item_id, event_id FROM ev
ORDER BY "timestamp" DESC, event_id DESC LIMIT 20"""
_NULLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
ORACLE["profile_nulls"] = (
    "WITH d AS (SELECT documents.*, quality, toxic FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id) "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM d" for c in _NULLS)
)
ORACLE["profile_values"] = with_(LG) + _value_counts("lg", ["source", "category"])
ORACLE["profile_log"] = with_(*E_BASE) + """SELECT count(*) AS n_rows, 12 AS n_columns, count(DISTINCT item_id) AS unique_items,
  count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS unique_sessions FROM im"""

# --- streams -----------------------------------------------------------------------------------------------------

ORACLE["stream_dedupe"] = with_(EV) + 'SELECT event_id, user_id, event_type, "timestamp" FROM ev'
ORACLE["stream_counts"] = with_(EV) + """SELECT * FROM (
  SELECT date_trunc('hour', "timestamp") AS window_start, date_trunc('hour', "timestamp") + interval '1' hour AS window_end, user_id,
    count(item_id) FILTER (event_type = 'impression') AS recent_impression_count,
    count(item_id) FILTER (event_type = 'click') AS recent_click_count,
    count(item_id) FILTER (event_type = 'save') AS recent_save_count,
    count(item_id) FILTER (event_type = 'hide') AS recent_hide_count
  FROM ev GROUP BY 1, 2, 3)"""
ORACLE["stream_sessions"] = with_(EV) + """SELECT min("timestamp") AS session_start,
  max("timestamp") + interval '12' hour AS session_end, user_id, count(*) AS events
FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) AS sid FROM (
  SELECT *, CASE WHEN "timestamp" < lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp", event_id)
    + interval '12' hour THEN 0 ELSE 1 END AS new FROM ev))
GROUP BY user_id, sid"""
ORACLE["stream_labels"] = with_(EV) + """SELECT i.event_id, i.user_id, i.session_id, i.item_id,
  CAST(EXISTS (SELECT 1 FROM ev c WHERE c.event_type = 'click' AND c.user_id = i.user_id AND c.session_id = i.session_id
    AND c.item_id = i.item_id AND c."timestamp" >= i."timestamp" AND c."timestamp" <= i."timestamp" + interval '2' day) AS int) AS clicked
FROM ev i WHERE i.event_type = 'impression'"""
ORACLE["stream_snapshot"] = with_(EV) + """SELECT user_id, event_type AS user_prev_category, "timestamp" AS feature_timestamp
FROM ev WHERE event_type IN ('impression', 'click')
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC, event_id DESC) = 1"""

# --- fills ------------------------------------------------------------------------------------

ORACLE["usual_fills"] = with_(*E_BASE) + """, r AS (SELECT event_id, impression_time, dwell_time, category,
    CASE WHEN age_hours >= 0 THEN age_hours END AS age, CASE WHEN age_hours >= 0 THEN source END AS src FROM im JOIN (SELECT event_id, dwell_time FROM ev) USING (event_id)),
  fit AS (SELECT * FROM r WHERE impression_time < timestamp '2024-01-15'),
  m AS (SELECT median(age) AS age, median(dwell_time) AS dwell,
    (SELECT src FROM fit WHERE src IS NOT NULL GROUP BY src ORDER BY count(*) DESC, src LIMIT 1) AS src,
    (SELECT category FROM fit WHERE category IS NOT NULL GROUP BY category ORDER BY count(*) DESC, category LIMIT 1) AS cat FROM fit)
SELECT event_id, round(coalesce(r.age, m.age), 6) AS age_hours_filled, round(coalesce(r.dwell_time, m.dwell), 6) AS dwell_time_filled,
  coalesce(r.src, m.src) AS source_known, coalesce(r.category, m.cat) AS category_known FROM r, m"""
