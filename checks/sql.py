"""The derived tables of ``checks/given.py`` in SQL, as named subqueries."""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def units(x: str, scale: str = "10000.0e0") -> str:
    return f"CAST(floor(({x}) * {scale} + 0.5e0) AS BIGINT)"


def xsum(x: str, scale: str = "10000.0e0") -> str:
    return f"(CAST(sum({units(x, scale)}) AS DOUBLE) / {scale})"


def xavg(x: str, scale: str = "10000.0e0") -> str:
    return f"(CAST(sum({units(x, scale)}) AS DOUBLE) / {scale} / count({x}))"


def rnd(x: str, n: int) -> str:
    s = f"{10**n}.0e0"
    return f"(floor(({x}) * {s} + 0.5e0) / {s})"


def completion(pos: str, dur: str, n: int = 2) -> str:
    return f"(CASE WHEN {dur} > 0 THEN least(100.0e0, {rnd(f'{pos} / {dur} * 100.0e0', n)}) ELSE 0.0e0 END)"


def minute(t: str) -> str:
    return f"CAST(epoch(date_trunc('minute', {t})) AS BIGINT)"


DEVICE = "CASE ({0}) % 5 WHEN 0 THEN 'smart_tv' WHEN 1 THEN 'mobile' WHEN 2 THEN 'tablet' WHEN 3 THEN 'web' ELSE 'streaming_stick' END"
EV = ("event_id, event_type, schema_version, user_id, session_id, device_id, device_type, app_version, content_id,"
      " position_seconds, playback_seconds, event_time, ingestion_time")
PLAY_TYPES = "('video_play', 'video_pause', 'video_seek', 'video_stop', 'video_complete')"
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

CTES: dict[str, str] = {
    "keyed": f"SELECT *, {K} AS k FROM events",
    "deliveries": "SELECT *, unnest(range(0, CASE WHEN k >= 95 THEN 2 ELSE 1 END)) AS delivery FROM keyed",
    "raw": f"""
      SELECT event_id,
        CASE event_type WHEN 'view' THEN 'video_play' WHEN 'signup' THEN 'video_pause' WHEN 'click' THEN 'video_seek'
          WHEN 'purchase' THEN 'video_complete' ELSE event_type END AS event_type,
        CASE WHEN k = 94 THEN '99.0.0-unauthorized' ELSE '1.0.0' END AS schema_version,
        user_id, user_id * 100 + day(ts) AS session_id, user_id * 10 + event_id % 5 AS device_id,
        {DEVICE.format('event_id')} AS device_type,
        '1.' || CAST(user_id % 3 AS VARCHAR) || '.0' AS app_version,
        CASE WHEN k = 98 THEN '' WHEN k <> 99 THEN (CASE WHEN k >= 90 THEN 'ghost_' ELSE 'cnt_' END) || lpad(CAST(k AS VARCHAR), 6, '0') END AS content_id,
        CASE WHEN k = 96 THEN -value ELSE value * 20.0e0 END AS position_seconds,
        CASE WHEN k = 95 AND value > 100 THEN value * 1000.0e0 ELSE value END AS playback_seconds,
        CASE WHEN k = 97 THEN ts + INTERVAL 40 DAY WHEN k = 93 THEN ts - INTERVAL 10 DAY ELSE ts END AS event_time,
        ts + to_seconds(delivery * 60 + 1) AS ingestion_time,
        user_id % 6 AS source_partition, k
      FROM deliveries""",
    "stg": f"""
      SELECT {EV}, source_partition FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time DESC) AS rn FROM raw
        WHERE content_id IS NOT NULL AND content_id <> '' AND event_type IN {PLAY_TYPES}
          AND event_time <= {AS_OF} + INTERVAL 2 HOUR) WHERE rn = 1""",
    "content": """
      SELECT 'cnt_' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS content_id, p_name AS title, [p_type, p_brand] AS genres,
        CASE WHEN p_size > 25 THEN 'en' ELSE 'hi' END AS language, 2005 + p_size % 20 AS release_year, p_brand AS director,
        CAST(floor(p_retailprice * 6.0e0) AS INTEGER) AS duration_seconds, 'U/A 13+' AS maturity_rating,
        p_type = 'PROMO' AS is_series, p_size AS total_seasons FROM part""",
    "searches": f"""
      SELECT event_id, user_id, user_id * 100 + day(ts) AS session_id, user_id * 10 AS device_id, 'web' AS device_type,
        'query ' || CAST(k AS VARCHAR) AS query_text, k % 20 AS results_count,
        CASE WHEN k >= 80 THEN '' WHEN k >= 30 THEN 'cnt_' || lpad(CAST(k AS VARCHAR), 6, '0') END AS selected_content_id,
        ts AS event_time, ts + INTERVAL 1 SECOND AS ingestion_time FROM keyed WHERE event_type = 'signup'""",
    "recs": """
      SELECT event_id, user_id, CASE event_type WHEN 'click' THEN 'recommendation_click' ELSE 'recommendation_impression' END AS event_type,
        'm' || CAST(k % 3 AS VARCHAR) AS model_version, ts AS event_time FROM keyed WHERE event_type IN ('view', 'click')""",
    "sessions": f"""
      SELECT g.user_id, g.session_id, g.content_id, c.title AS content_title, g.device_type, session_start, session_end,
        total_watch_seconds, pause_count, seek_count, {completion('max_pos', 'c.duration_seconds')} AS completion_percentage,
        ({minute('session_end')} - {minute('session_start')}) // 60 AS session_duration_minutes
      FROM (SELECT user_id, session_id, content_id, min(device_type) AS device_type, min(event_time) AS session_start,
              max(event_time) AS session_end, {xsum('playback_seconds')} AS total_watch_seconds,
              count(*) FILTER (WHERE event_type = 'video_pause') AS pause_count,
              count(*) FILTER (WHERE event_type = 'video_seek') AS seek_count, max(position_seconds) AS max_pos
            FROM stg GROUP BY user_id, session_id, content_id) g
      LEFT JOIN content c ON g.content_id = c.content_id""",
    "activity": f"""
      SELECT *, {rnd('daily_watch_seconds / 3600.0e0', 2)} AS daily_watch_hours FROM (
        SELECT user_id, CAST(session_start AS DATE) AS activity_date, count(session_id) AS sessions_count,
          {xsum('total_watch_seconds')} AS daily_watch_seconds, {xavg('completion_percentage')} AS avg_completion_pct
        FROM sessions GROUP BY user_id, CAST(session_start AS DATE))""",
    "engagement": f"""
      SELECT *, {rnd('total_watch_seconds / 3600.0e0', 2)} AS total_watch_hours,
        dense_rank() OVER (PARTITION BY engagement_date ORDER BY total_watch_seconds DESC) AS daily_rank FROM (
        SELECT content_id, content_title, CAST(session_start AS DATE) AS engagement_date, count(session_id) AS total_sessions,
          count(DISTINCT user_id) AS unique_viewers, {xsum('total_watch_seconds')} AS total_watch_seconds,
          {rnd(xavg('completion_percentage'), 2)} AS avg_completion_percentage
        FROM sessions GROUP BY content_id, content_title, CAST(session_start AS DATE))""",
    "churn": f"""
      SELECT w.user_id, genre_watch_minutes_7d, genre_watch_minutes_30d, content_completion_rate,
        coalesce(search_count_7d, 0) AS search_count_7d, active_days_30d, coalesce(recommendation_ctr, 0.0e0) AS recommendation_ctr,
        average_session_length
      FROM (SELECT user_id,
          {rnd(f"CAST(sum(CASE WHEN session_start >= {AS_OF} - INTERVAL 7 DAY THEN {units('total_watch_seconds')} ELSE 0 END) AS DOUBLE) / 10000.0e0 / 60.0e0", 2)} AS genre_watch_minutes_7d,
          {rnd(f"CAST(sum(CASE WHEN session_start >= {AS_OF} - INTERVAL 30 DAY THEN {units('total_watch_seconds')} ELSE 0 END) AS DOUBLE) / 10000.0e0 / 60.0e0", 2)} AS genre_watch_minutes_30d,
          {rnd(xavg('completion_percentage'), 2)} AS content_completion_rate,
          {rnd(xavg('total_watch_seconds') + ' / 60.0e0', 2)} AS average_session_length,
          count(DISTINCT CASE WHEN session_start >= {AS_OF} - INTERVAL 30 DAY THEN CAST(session_start AS DATE) END) AS active_days_30d
        FROM sessions GROUP BY user_id) w
      LEFT JOIN (SELECT user_id, count(*) FILTER (WHERE event_time >= {AS_OF} - INTERVAL 7 DAY) AS search_count_7d FROM searches GROUP BY user_id) s
        ON w.user_id = s.user_id
      LEFT JOIN (SELECT user_id, {rnd("count(*) FILTER (WHERE event_type = 'recommendation_click') / greatest(count(*), 1) * 100.0e0", 2)} AS recommendation_ctr
        FROM recs GROUP BY user_id) r ON w.user_id = r.user_id""",
    "daily": f"""
      SELECT activity_date AS metric_date, count(user_id) AS daily_active_users, CAST(sum(sessions_count) AS BIGINT) AS total_watch_sessions,
        {rnd(xsum('daily_watch_hours'), 2)} AS total_watch_hours,
        {rnd(xavg('daily_watch_seconds') + ' / 60.0e0', 2)} AS avg_daily_watch_minutes,
        {rnd(xavg('avg_completion_pct', '10000000.0e0'), 2)} AS avg_platform_completion_pct
      FROM activity GROUP BY activity_date""",
    "rich": """
      SELECT s.*, coalesce(c.title, 'Unknown Title') AS content_title, coalesce(CAST(c.duration_seconds AS DOUBLE), 7200.0e0) AS content_duration_seconds
      FROM stg s LEFT JOIN content c ON s.content_id = c.content_id""",
    "silver": f"""
      SELECT event_id, event_type, user_id, session_id, device_id, device_type, app_version, content_id, content_title,
        CAST(content_duration_seconds AS INTEGER) AS content_duration_seconds, position_seconds, playback_seconds,
        {completion('position_seconds', 'greatest(content_duration_seconds, 1.0e0)')} AS completion_percentage,
        event_time < max(event_time) OVER (PARTITION BY source_partition ORDER BY event_id ROWS UNBOUNDED PRECEDING) - INTERVAL 30 SECOND AS is_late_arriving,
        event_time, {AS_OF} AS processed_time FROM rich""",
    "users": """
      SELECT c_custkey AS user_id,
        CASE WHEN c_acctbal >= 0 THEN lower(replace(c_name, '#', '.')) || '@mail' || CAST(c_nationkey AS VARCHAR) || '.example.com' END AS email,
        CASE WHEN c_acctbal > 9000 THEN NULL WHEN c_acctbal > 8000 THEN '12345' ELSE '+91' || lpad(CAST(c_custkey AS VARCHAR), 10, '9') END AS phone,
        'C' || CAST(c_nationkey AS VARCHAR) AS country_code,
        CAST(DATE '2020-01-01' + c_nationkey AS TIMESTAMP) AS created_at,
        '10.' || CAST(c_nationkey AS VARCHAR) || '.' || CAST(c_custkey % 256 AS VARCHAR) || '.7' AS ip FROM customer""",
    "masked_users": """
      SELECT *, CASE WHEN email IS NULL THEN 'anonymized@example.invalid'
          ELSE substr(email, 1, 1) || '***' || CASE WHEN instr(email, '@') > 3 THEN substr(email, instr(email, '@') - 1, 1) ELSE '' END
            || substr(email, instr(email, '@')) END AS email_masked,
        CASE WHEN phone IS NULL THEN '+XX-XXXXX-XXXXX' WHEN length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 10
          THEN '+91-XXXXX-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4) ELSE '+XX-XXXX-XXXX' END AS phone_masked FROM users""",
    "plans": "SELECT 'plan_' || CAST(r_regionkey AS VARCHAR) AS plan_id, r_name AS plan_name FROM region",
    "subs": """
      SELECT o_orderkey AS subscription_id, o_custkey AS user_id, 'plan_' || CAST(o_orderkey % 5 AS VARCHAR) AS plan_id,
        CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'past_due' ELSE 'canceled' END AS status, o_orderdate AS updated_at,
        CASE o_orderstatus WHEN 'O' THEN 'c' WHEN 'P' THEN 'u' ELSE 'd' END AS op FROM orders""",
    "basket_rows": """
      SELECT DISTINCT o_custkey AS user_id, p_brand || '/' || p_type AS content_id
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "baskets": "SELECT * FROM basket_rows WHERE user_id IN (SELECT user_id FROM basket_rows GROUP BY user_id HAVING count(*) >= 2)",
    "basket_n": "SELECT count(DISTINCT user_id) AS n FROM baskets",
    "item_n": "SELECT content_id, count(*) AS c FROM baskets GROUP BY content_id",
    "pair_n": """
      SELECT x.content_id AS a, y.content_id AS b, count(*) AS co FROM baskets x JOIN baskets y
        ON x.user_id = y.user_id AND x.content_id <> y.content_id GROUP BY x.content_id, y.content_id""",
    "rules": f"""
      SELECT a AS antecedent_content_id, b AS consequent_content_id, {rnd('co / n', 5)} AS support,
        {rnd('(co / n) / (i.c / n)', 4)} AS confidence,
        {rnd('(co / n) / ((least_c / n) * (most_c / n))', 3)} AS lift, co AS co_watch_count
      FROM (SELECT p.*, CASE WHEN a < b THEN ia.c ELSE ib.c END AS least_c, CASE WHEN a < b THEN ib.c ELSE ia.c END AS most_c
            FROM pair_n p JOIN item_n ia ON ia.content_id = a JOIN item_n ib ON ib.content_id = b) q
      JOIN item_n i ON i.content_id = a, basket_n
      WHERE co >= 0.005e0 * n AND (co / n) / ((least_c / n) * (most_c / n)) >= 1.0e0""",
    "items": """
      SELECT p_brand || '/' || p_type AS content_id, min(p_name) AS title, min(2005 + p_size % 20) AS release_year,
        max(CAST(floor(p_retailprice * 6.0e0) AS INTEGER)) AS duration_seconds, 'U/A 13+' AS maturity_rating
      FROM part GROUP BY p_brand || '/' || p_type""",
    "chunks": """
      SELECT vec_id AS chunk_id, 'Brand#' || CAST(vec_id % 25 + 1 AS VARCHAR) || '/' || CASE label % 6 WHEN 0 THEN 'STANDARD'
          WHEN 1 THEN 'ECONOMY' WHEN 2 THEN 'LARGE' WHEN 3 THEN 'MEDIUM' WHEN 4 THEN 'SMALL' ELSE 'PROMO' END AS content_id,
        label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings""",
    "neighbours": f"""
      SELECT q.chunk_id AS query_id, c.chunk_id, c.content_id, {rnd('list_cosine_similarity(q.vec, c.vec)', 10)} AS s
      FROM chunks q, chunks c""",
    "hits": f"""
      SELECT query_id, chunk_id, content_id, {rnd('s', 4)} AS similarity_score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, chunk_id) AS rank FROM neighbours) WHERE rank <= 10""",
    "item_sims": """
      SELECT f.content_id AS item_id, h.content_id, max(similarity_score) AS semantic_score FROM hits h
      JOIN (SELECT content_id, min(chunk_id) AS query_id FROM chunks GROUP BY content_id) f ON f.query_id = h.query_id
      WHERE f.content_id <> h.content_id GROUP BY f.content_id, h.content_id""",
    "co_own": """
      SELECT *, row_number() OVER (PARTITION BY antecedent_content_id ORDER BY lift DESC, confidence DESC, consequent_content_id) AS rank FROM rules""",
    "all_items": "SELECT content_id FROM items UNION SELECT content_id FROM chunks",
    "co_watch": """
      SELECT antecedent_content_id AS item_id, consequent_content_id AS content_id, support, confidence, lift, co_watch_count, rank, false AS is_fallback
      FROM co_own WHERE antecedent_content_id IN (SELECT content_id FROM all_items)
      UNION ALL
      SELECT i.content_id, g.consequent_content_id, g.support, g.confidence, g.lift, g.co_watch_count, g.rank, true FROM all_items i,
        (SELECT *, row_number() OVER (ORDER BY lift DESC, co_watch_count DESC, antecedent_content_id, consequent_content_id) AS rank FROM rules) g
      WHERE i.content_id NOT IN (SELECT antecedent_content_id FROM rules)""",
    "item_hybrid": f"""
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, content_id) AS rank FROM (
        SELECT coalesce(w.item_id, s.item_id) AS item_id, coalesce(w.content_id, s.content_id) AS content_id,
          coalesce(lift, 1.0e0) AS lift, coalesce(confidence, 0.0e0) AS confidence, coalesce(semantic_score, 0.0e0) AS semantic_score,
          {rnd('CASE WHEN lift IS NULL THEN 0.0e0 ELSE least(lift / 10.0e0, 1.0e0) * 0.6e0 END + coalesce(semantic_score * 0.4e0, 0.0e0)', 4)} AS score,
          CASE WHEN s.item_id IS NULL THEN 'MARKET_BASKET_LIFT' WHEN w.item_id IS NULL THEN 'PGVECTOR_SEMANTIC'
            ELSE 'HYBRID_CO_WATCH_SEMANTIC' END AS strategy
        FROM (SELECT item_id, content_id, max(lift) AS lift, max(confidence) AS confidence FROM co_watch
              WHERE rank <= 10 AND item_id <> content_id GROUP BY item_id, content_id) w
        FULL JOIN item_sims s ON w.item_id = s.item_id AND w.content_id = s.content_id)) WHERE rank <= 5""",
    "implicit": f"""
      SELECT user_id, content_id, (CASE WHEN pos > 0 THEN least(pos / 5400.0e0, 1.0e0) ELSE least(play / 3600.0e0, 1.0e0) END) * ln(1.0e0 + (play + 1.0e0)) AS score
      FROM (SELECT user_id, content_id, max(position_seconds) AS pos, max(playback_seconds) AS play FROM stg GROUP BY user_id, content_id)""",
    "violations": f"""
      SELECT sha256(CAST(event_id AS VARCHAR) || '|' || strftime(ingestion_time, '%Y-%m-%d %H:%M:%S.%f') || '|' || code) AS quarantine_id,
        {AS_OF} AS quarantine_time, 'raw_playback_events' AS source_table, event_id, code AS violation_code, details AS violation_details, payload AS raw_payload
      FROM (
        SELECT event_id, ingestion_time, 'FUTURE_TIMESTAMP' AS code,
          'event_time ' || strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') || ' is ahead of current clock' AS details,
          '{{"user_id":"' || CAST(user_id AS VARCHAR) || '",' || CASE WHEN content_id IS NULL THEN '' ELSE '"content_id":"' || content_id || '",' END
            || '"event_time":"' || strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') || '"}}' AS payload
        FROM raw WHERE event_time > {AS_OF} + INTERVAL 10 MINUTE
        UNION ALL
        SELECT event_id, ingestion_time, 'UNKNOWN_CONTENT_ID', 'content_id ' || content_id || ' not present in dim_content',
          '{{"user_id":"' || CAST(user_id AS VARCHAR) || '","content_id":"' || content_id || '"}}'
        FROM raw WHERE content_id <> '' AND content_id NOT IN (SELECT content_id FROM content)
        UNION ALL
        SELECT event_id, ingestion_time, 'IMPOSSIBLE_PLAYBACK_VALUE',
          'playback_seconds=' || CAST(playback_seconds AS VARCHAR) || ', position_seconds=' || CAST(position_seconds AS VARCHAR),
          '{{"playback_seconds":' || CAST(playback_seconds AS VARCHAR) || ',"position_seconds":' || CAST(position_seconds AS VARCHAR) || '}}'
        FROM raw WHERE playback_seconds > 86400 OR position_seconds < 0)""",
    "rates": f"""
      SELECT greatest(count(*), 1) AS total_records, {rnd("count(*) FILTER (WHERE user_id IS NULL) / greatest(count(*), 1)", 4)} AS null_user_rate,
        {rnd("count(*) FILTER (WHERE content_id IS NULL OR content_id = '') / greatest(count(*), 1)", 4)} AS null_content_rate,
        {rnd("(count(*) - count(DISTINCT event_id)) / greatest(count(*), 1)", 4)} AS duplicate_rate FROM raw""",
    "fresh": f"SELECT max(event_time) AS max_event_time, (epoch_us({AS_OF}) - epoch_us(max(event_time))) / 1000000.0e0 AS lag_seconds FROM raw",
}


def with_tables(sql: str) -> str:
    """Put the named subqueries a statement mentions in front of it."""
    seen: set[str] = set()
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\w+", text):
            if name in CTES and name not in seen:
                seen.add(name)
                visit(CTES[name])
                ordered.append(name)

    visit(sql)
    parts = ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered)
    return f"WITH {parts}\n{sql}" if parts else sql
