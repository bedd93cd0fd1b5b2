"""Independent SQL (DuckDB dialect) for every registered query.

The SQL rebuilds the change feed from ``events`` as JSON text, parses it with
DuckDB's JSON functions and applies the rules as written (window-function
dedup, joins before aggregation), so it checks the Spark plans rather than
repeating them. Column names and types follow the Spark outputs.
"""

from __future__ import annotations

from tributary.plans import catalog as C
from tributary.schemas import QUALITY_RULE_VERSION, SOURCE_SYSTEM


def _lit_date(d) -> str:
    return f"DATE '{d.isoformat()}'"


AS_OF_TS = f"TIMESTAMP '{C.AS_OF.isoformat(sep=' ')}'"
AS_OF_DATE = _lit_date(C.AS_OF.date())


def clean_sql(expr: str) -> str:
    """SQL twin of ``clean_text``."""
    steps = [
        ("<[^>]*>", " "),
        ("&nbsp;|&#160;", " "),
        ("&quot;", '"'),
        ("&#39;|&apos;", "''"),
        ("&amp;", "&"),
        (r"\s+", " "),
    ]
    out = f"coalesce({expr}, '')"
    for pattern, repl in steps:
        out = f"regexp_replace({out}, '{pattern}', '{repl}', 'g')"
    return f"trim({out})"


def blank_to_null_sql(expr: str) -> str:
    cleaned = clean_sql(expr)
    return f"CASE WHEN length({cleaned}) > 0 THEN {cleaned} END"


def key_sql(*columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '__null__')" for c in columns)
    return f"sha256(concat_ws('||', {parts}))"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR length(trim({c})) = 0)"


_MISSING = {
    "meta_id": _blank("meta_id"),
    "event_id": "event_id IS NULL",
    "event_type": _blank("event_type"),
    "wiki": _blank("wiki"),
    "namespace": "namespace IS NULL",
    "page_title": _blank("page_title"),
}
_MISSING_LIST = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _MISSING.items()
) + ")"
_MISSING_ANY = " OR ".join(f"({c})" for c in _MISSING.values())
_RAW_MISSING = _blank("raw_message")
_PARSE_FAILED = (
    f"(NOT {_RAW_MISSING} AND meta_id IS NULL AND event_id IS NULL AND event_type IS NULL "
    "AND wiki IS NULL AND page_title IS NULL)"
)

PAYLOAD_SQL = """json_object(
      'id', n,
      'type', ' ' || upper(event_type),
      'namespace', n % 4,
      'title', CASE WHEN d = 5 THEN '  ' WHEN d = 9 THEN '<b></b>'
                    ELSE '<i>Page ' || CAST(n % 50 AS VARCHAR) || '</i> &amp; more' END,
      'title_url', 'https://' || site || '/' || CAST(n % 50 AS VARCHAR),
      'comment', 'edit&nbsp;' || CAST(n % 10 AS VARCHAR),
      'parsedcomment', CASE WHEN n % 2 = 0 THEN '<a href="x">edit</a>  ' || CAST(n % 10 AS VARCHAR) END,
      'timestamp', CASE WHEN d <> 6 THEN CAST(floor(epoch(ts)) AS BIGINT) END,
      'user', 'user' || CAST(user_id AS VARCHAR),
      'bot', CASE WHEN n % 13 <> 0 THEN user_id % 7 = 0 END,
      'server_name', site,
      'wiki', CASE WHEN d <> 4 THEN 'Wiki' || CAST(user_id % 5 AS VARCHAR) END,
      'meta', json_object(
          'id', 'm-' || CAST(CASE WHEN d = 11 THEN n - 1 ELSE n END AS VARCHAR),
          'domain', site,
          'stream', 'changes',
          'dt', CASE WHEN d IN (6, 7) THEN 'bad'
                     WHEN d <> 8 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END))"""

CTES = f"""
feed_src AS (
  SELECT event_id AS n, event_id % 100 AS d, user_id, event_type, ts,
         'w' || CAST(user_id % 5 AS VARCHAR) || '.example.org' AS site
  FROM events
),
feed AS (
  SELECT n, d, ts,
         CASE d WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN 'not json' WHEN 3 THEN '{{}}'
                ELSE CAST({PAYLOAD_SQL} AS VARCHAR) END AS value,
         ts + INTERVAL 1 MINUTE
            + CASE WHEN d = 10 THEN INTERVAL 5 DAY ELSE INTERVAL 0 DAY END AS ingested_at
  FROM feed_src
),
bronze AS (
  SELECT 'changes' AS kafka_topic,
         CAST(n % 3 AS INTEGER) AS kafka_partition,
         CAST(n // 3 AS BIGINT) AS kafka_offset,
         ts AS kafka_timestamp,
         CAST(NULL AS VARCHAR) AS message_key,
         value AS raw_message,
         ingested_at AS bronze_ingested_at,
         '{SOURCE_SYSTEM}' AS source_system,
         CAST(ingested_at AS DATE) AS bronze_ingested_date
  FROM feed
),
bronze_json AS (
  SELECT *, CASE WHEN json_valid(raw_message) AND json_type(raw_message) = 'OBJECT'
                 THEN CAST(raw_message AS JSON) END AS j
  FROM bronze
),
loaded AS (
  SELECT kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, message_key, raw_message,
         bronze_ingested_at, source_system,
         json_extract_string(j, '$.meta.id') AS meta_id,
         json_extract_string(j, '$.meta.domain') AS domain,
         json_extract_string(j, '$.meta.stream') AS stream_name,
         json_extract_string(j, '$.meta.dt') AS event_datetime,
         TRY_CAST(json_extract(j, '$.id') AS BIGINT) AS event_id,
         TRY_CAST(json_extract(j, '$.timestamp') AS BIGINT) AS event_unix_timestamp,
         json_extract_string(j, '$.type') AS event_type,
         TRY_CAST(json_extract(j, '$.namespace') AS BIGINT) AS namespace,
         json_extract_string(j, '$.title') AS page_title,
         json_extract_string(j, '$.title_url') AS page_url,
         json_extract_string(j, '$.user') AS event_user,
         TRY_CAST(json_extract(j, '$.bot') AS BOOLEAN) AS is_bot,
         json_extract_string(j, '$.server_name') AS server_name,
         json_extract_string(j, '$.wiki') AS wiki,
         json_extract_string(j, '$.comment') AS comment,
         json_extract_string(j, '$.parsedcomment') AS parsed_comment,
         TRY_CAST(json_extract(j, '$.minor') AS BOOLEAN) AS is_minor,
         TRY_CAST(json_extract(j, '$.patrolled') AS BOOLEAN) AS is_patrolled
  FROM bronze_json
),
timed AS (
  SELECT *,
         coalesce(try_strptime(event_datetime, '%Y-%m-%dT%H:%M:%SZ'),
                  make_timestamp(event_unix_timestamp * 1000000)) AS parsed_event_datetime,
         CAST(bronze_ingested_at AS DATE) AS bronze_ingested_date
  FROM loaded
),
dated AS (
  SELECT * REPLACE (CASE WHEN year(parsed_event_datetime) BETWEEN 1 AND 214748 THEN parsed_event_datetime END
                    AS parsed_event_datetime),
         CAST(CASE WHEN year(parsed_event_datetime) BETWEEN 1 AND 214748 THEN parsed_event_datetime END AS DATE)
           AS event_date
  FROM timed
),
prepared AS (
  SELECT *,
         CAST(date_diff('day', event_date, bronze_ingested_date) AS INTEGER) AS arrival_lag_days,
         coalesce(date_diff('day', event_date, bronze_ingested_date) > {C.LATE_ARRIVAL_DAYS}, false)
           AS is_late_arriving,
         {AS_OF_TS} AS quality_checked_at,
         {AS_OF_DATE} AS quality_checked_date,
         coalesce(event_date, bronze_ingested_date, {AS_OF_DATE}) AS processing_window_date,
         '{QUALITY_RULE_VERSION}' AS quality_rule_version,
         {_MISSING_LIST} AS missing_required_fields,
         CASE WHEN {_RAW_MISSING} THEN 'raw_message_missing'
              WHEN {_PARSE_FAILED} THEN 'schema_parse_failed'
              WHEN {_MISSING_ANY} THEN 'missing_required_field'
              WHEN parsed_event_datetime IS NULL THEN 'invalid_event_timestamp' END
           AS quality_error_category,
         CASE WHEN {_RAW_MISSING} THEN 'Raw Kafka message is null or blank.'
              WHEN {_PARSE_FAILED} THEN 'Raw message did not parse into the expected Wikimedia schema.'
              WHEN {_MISSING_ANY} THEN {_MISSING_LIST}
              WHEN parsed_event_datetime IS NULL
                THEN 'Event timestamp could not be parsed from meta.dt or timestamp.' END
           AS quality_error_reason
  FROM dated
),
valid_deduped AS (
  SELECT * FROM prepared
  WHERE quality_error_category IS NULL
    AND event_id IS NOT NULL AND meta_id IS NOT NULL AND event_type IS NOT NULL
    AND wiki IS NOT NULL AND page_title IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY meta_id
                             ORDER BY kafka_topic, kafka_partition, kafka_offset) = 1
),
silver AS (
  SELECT event_id, meta_id, lower(trim(event_type)) AS event_type,
         parsed_event_datetime AS event_datetime,
         CAST(parsed_event_datetime AS DATE) AS event_date,
         lower(trim(wiki)) AS wiki, lower(trim(domain)) AS domain,
         lower(trim(stream_name)) AS stream_name, namespace,
         {blank_to_null_sql('page_title')} AS page_title,
         {blank_to_null_sql('page_url')} AS page_url,
         {blank_to_null_sql('event_user')} AS event_user,
         coalesce(is_bot, false) AS is_bot, coalesce(is_minor, false) AS is_minor,
         coalesce(is_patrolled, false) AS is_patrolled,
         lower(trim(server_name)) AS server_name,
         {blank_to_null_sql('coalesce(parsed_comment, comment)')} AS comment,
         bronze_ingested_at, source_system, message_key, kafka_topic, kafka_partition,
         kafka_offset, kafka_timestamp, arrival_lag_days, is_late_arriving,
         processing_window_date, quality_checked_at, quality_rule_version
  FROM valid_deduped
  WHERE parsed_event_datetime IS NOT NULL
),
modeled AS (
  SELECT *,
         CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS date_key,
         {key_sql('wiki', 'domain', 'server_name')} AS wiki_key,
         {key_sql('wiki', 'namespace', 'page_title', 'page_url')} AS page_key,
         {key_sql('event_user', 'is_bot')} AS user_key,
         {key_sql('event_type')} AS event_type_key
  FROM silver
),
dim_date AS (
  SELECT date_key, event_date,
         CAST(year(event_date) AS INTEGER) AS year,
         CAST(quarter(event_date) AS INTEGER) AS quarter,
         CAST(month(event_date) AS INTEGER) AS month,
         CAST(day(event_date) AS INTEGER) AS day,
         CAST(dayofweek(event_date) + 1 AS INTEGER) AS day_of_week
  FROM (SELECT DISTINCT date_key, event_date FROM modeled WHERE date_key IS NOT NULL)
),
dim_wiki AS (
  SELECT wiki_key, wiki, domain, server_name, stream_name, source_system FROM modeled
  QUALIFY row_number() OVER (PARTITION BY wiki_key ORDER BY wiki NULLS FIRST,
          domain NULLS FIRST, server_name NULLS FIRST, stream_name NULLS FIRST,
          source_system NULLS FIRST) = 1
),
dim_page AS (
  SELECT page_key, wiki_key, namespace, page_title, page_url FROM modeled
  QUALIFY row_number() OVER (PARTITION BY page_key ORDER BY wiki_key NULLS FIRST,
          namespace NULLS FIRST, page_title NULLS FIRST, page_url NULLS FIRST) = 1
),
dim_user AS (
  SELECT user_key, coalesce(event_user, 'unknown') AS event_user, is_bot FROM modeled
  QUALIFY row_number() OVER (PARTITION BY user_key
          ORDER BY coalesce(event_user, 'unknown') NULLS FIRST, is_bot NULLS FIRST) = 1
),
dim_event_type AS (
  SELECT event_type_key, event_type FROM modeled
  QUALIFY row_number() OVER (PARTITION BY event_type_key ORDER BY event_type NULLS FIRST) = 1
),
fact_recent_changes AS (
  SELECT {key_sql('meta_id')} AS recent_change_key, meta_id, event_id, date_key, wiki_key,
         page_key, user_key, event_type_key, event_datetime, event_date,
         CAST(hour(event_datetime) AS INTEGER) AS event_hour, namespace, is_bot, is_minor,
         is_patrolled, comment, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp,
         bronze_ingested_at, arrival_lag_days, is_late_arriving, processing_window_date,
         quality_checked_at, quality_rule_version
  FROM modeled
  QUALIFY row_number() OVER (PARTITION BY meta_id
                             ORDER BY kafka_topic, kafka_partition, kafka_offset) = 1
),
base AS (
  SELECT f.recent_change_key, f.event_datetime, f.event_date, f.event_hour,
         coalesce(et.event_type, 'unknown') AS event_type,
         coalesce(w.wiki, 'unknown') AS wiki,
         coalesce(p.page_title, 'unknown') AS page_title,
         coalesce(p.namespace, -1) AS namespace,
         coalesce(u.event_user, 'unknown') AS event_user,
         coalesce(u.is_bot, f.is_bot, false) AS is_bot,
         f.comment, f.user_key, f.page_key
  FROM fact_recent_changes f
  LEFT JOIN dim_wiki w ON f.wiki_key = w.wiki_key
  LEFT JOIN dim_page p ON f.page_key = p.page_key
  LEFT JOIN dim_user u ON f.user_key = u.user_key
  LEFT JOIN dim_event_type et ON f.event_type_key = et.event_type_key
),
agg_dashboard_kpis AS (
  SELECT count(*) AS events,
         CAST(sum(CASE WHEN is_bot THEN 1 ELSE 0 END) AS BIGINT) AS bot_events,
         count(DISTINCT user_key) AS unique_users,
         count(DISTINCT page_key) AS unique_pages
  FROM fact_recent_changes
),
agg_events_by_date AS (
  SELECT event_date, count(*) AS events FROM fact_recent_changes GROUP BY event_date
),
agg_events_by_window AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, event_datetime) AS window_start,
         time_bucket(INTERVAL 15 MINUTE, event_datetime) + INTERVAL 15 MINUTE AS window_end,
         event_date, event_hour, count(*) AS events
  FROM fact_recent_changes WHERE event_datetime IS NOT NULL
  GROUP BY 1, 2, 3, 4
),
agg_events_by_type AS (SELECT event_type, count(*) AS events FROM base GROUP BY 1),
agg_events_by_wiki AS (SELECT wiki, count(*) AS events FROM base GROUP BY 1),
agg_top_users AS (SELECT event_user, is_bot, count(*) AS events FROM base GROUP BY 1, 2),
agg_top_pages AS (SELECT page_title, namespace, count(*) AS events FROM base GROUP BY 1, 2),
recent_events_snapshot AS (
  SELECT event_datetime, event_date, event_type, wiki, page_title, event_user, is_bot,
         namespace, comment
  FROM base ORDER BY event_datetime DESC NULLS LAST, recent_change_key LIMIT {C.MAX_RECENT_ROWS}
),
quarantine AS (
  SELECT quality_error_category, quality_error_reason, quality_checked_at, quality_checked_date,
         quality_rule_version, missing_required_fields, raw_message, source_system, message_key,
         kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, bronze_ingested_at,
         bronze_ingested_date, processing_window_date, meta_id, event_id, event_type,
         event_datetime, event_unix_timestamp, parsed_event_datetime, event_date, wiki, domain,
         namespace, page_title, event_user
  FROM prepared WHERE quality_error_category IS NOT NULL
),
recent_in_range AS (
  SELECT * FROM recent_events_snapshot
  WHERE event_date BETWEEN {_lit_date(C.SERVING_START)} AND {_lit_date(C.SERVING_END)}
),
fresh_filtered AS (
  SELECT max(event_datetime) AS latest_event FROM recent_in_range
),
fresh_all AS (
  SELECT max(event_datetime) AS latest_event FROM recent_events_snapshot
)"""


def _with(select: str) -> str:
    return f"WITH {CTES}\n{select}"


def _freshness_sql(source: str) -> str:
    age = f"(epoch_us({AS_OF_TS}) - epoch_us(latest_event))"
    return f"""SELECT latest_event,
       CASE WHEN latest_event IS NULL THEN 'Unknown'
            WHEN {age} <= {C.STALE_AFTER_MINUTES * 60_000_000} THEN 'Fresh'
            ELSE 'Stale' END AS freshness,
       CASE WHEN latest_event IS NULL THEN 'No event timestamp available'
            ELSE CAST(greatest({age} // 60000000, 0) AS VARCHAR) || ' min old' END
         AS freshness_detail
FROM {source}"""


def _metric(check: str, metric: str, value: str, failed: str = "false", source: str = "") -> str:
    src = f" FROM {source}" if source else ""
    return (
        f"SELECT '{check}' AS \"check\", '{metric}' AS metric, CAST({value} AS BIGINT) AS value, "
        f"{failed} AS failed{src}"
    )


def _dup_count(source: str, keys: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {keys} HAVING count(*) > 1))"


def _gold_checks() -> str:
    parts = []
    for name in C.GOLD_NAMES + ("recent_events_snapshot",):
        parts.append(_metric(f"gold_{name}", "rows", "count(*)", "count(*) = 0", name))
        if name == "fact_recent_changes":
            dup = _dup_count(name, "recent_change_key")
            parts.append(_metric("gold_fact_recent_changes", "duplicate_keys", dup, f"{dup} > 0"))
            parts.append(_metric("gold_fact_recent_changes", "is_late_arriving_rows",
                                 "count(*) FILTER (WHERE is_late_arriving)", "false", name))
    return "\nUNION ALL ".join(parts)


def _silver_checks() -> str:
    dup = _dup_count("silver", "meta_id")
    parts = [
        _metric("silver", "rows", "count(*)", "count(*) = 0", "silver"),
        _metric("silver", "duplicate_keys", dup, f"{dup} > 0"),
    ]
    for c in ("meta_id", "event_id", "event_type", "event_date", "wiki", "page_title"):
        cnt = f"count(*) FILTER (WHERE {c} IS NULL)"
        parts.append(_metric("silver", f"null_{c}", cnt, f"{cnt} > 0", "silver"))
    parts.append(_metric("silver", "is_late_arriving_rows",
                         "count(*) FILTER (WHERE is_late_arriving)", "false", "silver"))
    return "\nUNION ALL ".join(parts)


def _readiness_checks() -> str:
    tables = [
        "agg_dashboard_kpis", "agg_events_by_date", "agg_events_by_window", "agg_events_by_type",
        "agg_events_by_wiki", "agg_top_users", "agg_top_pages", "recent_events_snapshot",
    ]
    parts = [_metric(f"dashboard_{t}", "rows", "count(*)", "count(*) = 0", t) for t in tables]
    parts.append(_metric("dashboard_kpis", "total_events", "coalesce(sum(events), 0)",
                         "coalesce(sum(events), 0) < 1", "agg_dashboard_kpis"))
    for m in ("bot_events", "unique_users", "unique_pages"):
        parts.append(_metric("dashboard_kpis", m, f"coalesce(sum({m}), 0)", "false", "agg_dashboard_kpis"))
    return "\nUNION ALL ".join(parts)


def _top(table: str, labels: list[str], n: int) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in labels)
    cols = ", ".join(labels)
    return f"SELECT {cols}, events FROM {table} ORDER BY events DESC NULLS LAST, {order} LIMIT {n}"


# Cleaned events without the quality stage: identifying fields, one row per
# meta_id, a readable time; the 24 Silver columns.
_TRANSFORMED = f"""
SELECT event_id, meta_id, lower(trim(event_type)) AS event_type, parsed_event_datetime AS event_datetime,
       event_date, lower(trim(wiki)) AS wiki, lower(trim(domain)) AS domain,
       lower(trim(stream_name)) AS stream_name, namespace, {blank_to_null_sql('page_title')} AS page_title,
       {blank_to_null_sql('page_url')} AS page_url, {blank_to_null_sql('event_user')} AS event_user,
       coalesce(is_bot, false) AS is_bot, coalesce(is_minor, false) AS is_minor,
       coalesce(is_patrolled, false) AS is_patrolled, lower(trim(server_name)) AS server_name,
       {blank_to_null_sql('coalesce(parsed_comment, comment)')} AS comment, bronze_ingested_at, source_system,
       message_key, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp
FROM (SELECT * FROM prepared
      WHERE event_id IS NOT NULL AND meta_id IS NOT NULL AND event_type IS NOT NULL
        AND wiki IS NOT NULL AND page_title IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY meta_id ORDER BY kafka_topic, kafka_partition, kafka_offset) = 1)
WHERE parsed_event_datetime IS NOT NULL"""

_LONG = (
    f"(repeat(' ', {C.LONG_RUN}) || html || repeat('<b>', {C.LONG_RUN}) || 'middle' "
    f"|| repeat('&nbsp;', {C.LONG_RUN}) || 'end')"
)


def _gold_select(name: str) -> str:
    return f"SELECT * FROM {name}"


def oracle_sql() -> dict[str, str]:
    ws, we = _lit_date(C.WINDOW_START), _lit_date(C.WINDOW_END)
    ss, se = _lit_date(C.SERVING_START), _lit_date(C.SERVING_END)
    lookback_from = f"({AS_OF_DATE} - INTERVAL {C.LOOKBACK_DAYS} DAY)"
    sql = {
        "bronze": "SELECT * FROM bronze",
        "loaded": "SELECT * FROM loaded",
        "quality_prepared": "SELECT * EXCLUDE (raw_message) FROM prepared",
        "quality_category_counts": (
            "SELECT quality_error_category, count(*) AS rows FROM prepared GROUP BY 1"
        ),
        "quarantine": "SELECT * FROM quarantine",
        "processing_window": (
            "SELECT processing_window_date, quality_error_category, count(*) AS rows FROM prepared "
            f"WHERE processing_window_date >= {ws} AND processing_window_date <= {we} GROUP BY 1, 2"
        ),
        "processing_lookback": (
            "SELECT processing_window_date, count(*) AS rows FROM prepared "
            f"WHERE processing_window_date >= CAST({lookback_from} AS DATE) GROUP BY 1"
        ),
        "silver": "SELECT * FROM silver",
    }
    sql.update({name: _gold_select(name) for name in C.GOLD_NAMES})
    sql.update(
        {
            "recent_events_snapshot": "SELECT * FROM recent_events_snapshot",
            "dashboard_base": "SELECT * EXCLUDE (recent_change_key) FROM base",
            "dashboard_base_of_silver": "SELECT * EXCLUDE (recent_change_key) FROM base",
            "published_after_stop": "SELECT * FROM fact_recent_changes",
            "published_switch": "SELECT * FROM agg_dashboard_kpis",
            "stream_bronze": "SELECT * EXCLUDE (bronze_ingested_at, bronze_ingested_date) FROM bronze",
            "stream_restart": "SELECT * EXCLUDE (bronze_ingested_at, bronze_ingested_date) FROM bronze",
            "bronze_batch_then_stream": "SELECT * EXCLUDE (bronze_ingested_at, bronze_ingested_date) FROM bronze",
            "bronze_stream_then_batch": "SELECT * EXCLUDE (bronze_ingested_at, bronze_ingested_date) FROM bronze",
            "batch_new_offsets": "SELECT * FROM bronze",
            "batch_offset_ledger": "SELECT * FROM bronze",
            "offset_ledger_ranges": """
SELECT * FROM (
WITH feed AS (SELECT (event_id % 3)::INTEGER AS p, event_id // 3 AS o FROM events),
border AS (SELECT (max(event_id) // 2) // 3 AS o FROM events),
batches AS (
  SELECT 0 AS batch, p, -2 AS starting FROM feed GROUP BY p
  UNION ALL SELECT 1, p, max(feed.o) + 1 FROM feed, border WHERE feed.o <= border.o GROUP BY p
  UNION ALL SELECT 2, p, max(o) + 1 FROM feed GROUP BY p)
SELECT batch, 'changes' AS topic, p AS kafka_partition, starting::BIGINT AS starting FROM batches)""",
            "bronze_loose_files": "SELECT * EXCLUDE (bronze_ingested_at, bronze_ingested_date) FROM bronze",
            "stream_trigger": "SELECT * EXCLUDE (bronze_ingested_at, bronze_ingested_date) FROM bronze",
            "layer_preview": f"SELECT * FROM silver ORDER BY meta_id LIMIT {C.TOP_N}",
            "topic_schema": """
SELECT * FROM (VALUES (0, 'key', 'binary'), (1, 'value', 'binary'), (2, 'topic', 'string'), (3, 'partition', 'int'),
  (4, 'offset', 'bigint'), (5, 'timestamp', 'timestamp')) t(position, "column", type)""",
            "kafka_scan": "SELECT * EXCLUDE (bronze_ingested_at, bronze_ingested_date) FROM bronze",
            "loaded_bronze": "SELECT * FROM loaded",
            "loaded_transformed": _TRANSFORMED,
            "silver_window_rerun": "SELECT * FROM silver",
            "quarantine_window_rerun": "SELECT * FROM quarantine",
            "silver_moved_survivor": "SELECT * FROM silver",
            "strict_gate": (
                "SELECT true AS gate_fired, (SELECT count(*) FROM silver) AS silver_rows, "
                "(SELECT count(*) FROM quarantine) AS quarantine_rows"
            ),
            "scheduled": "SELECT * FROM agg_events_by_date",
            "star_schema_rows": "\nUNION ALL ".join(
                f"SELECT '{name}' AS table_name, count(*) AS rows FROM {name}"
                for name in C.GOLD_NAMES + ("recent_events_snapshot",)
            ),
            "gold_refresh_kpis": "SELECT * FROM agg_dashboard_kpis",
            "gold_refresh_top_pages": "SELECT * FROM agg_top_pages",
            "gold_refresh_fact": "SELECT * FROM fact_recent_changes",
            "gold_refresh_snapshot": "SELECT * FROM recent_events_snapshot",
            "gold_refresh_rows": "\nUNION ALL ".join(
                f"SELECT '{name}' AS table_name, count(*) AS rows FROM {name}"
                for name in C.GOLD_NAMES + ("recent_events_snapshot",)
            ),
            "csv_exports": f"""
SELECT 'events_by_date' AS export, count(*) AS rows FROM agg_events_by_date WHERE event_date BETWEEN {ss} AND {se}
UNION ALL SELECT 'event_types', least(count(*), {C.TOP_N}) FROM agg_events_by_type
UNION ALL SELECT 'top_pages', least(count(*), {C.TOP_N}) FROM agg_top_pages
UNION ALL SELECT 'recent_events', least(count(*), {C.RECENT_ROWS}) FROM recent_in_range""",
            "csv_top_pages": _top("agg_top_pages", ["page_title", "namespace"], C.TOP_N),
            "dynamic_overwrite": (
                "SELECT event_id, CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value, "
                "event_type FROM events"
            ),
            "clean_text_long": f"""
SELECT page_id, {clean_sql(_LONG)} AS clean_html FROM pages""",
            "date_coercion": """
SELECT o_orderkey, TRY_CAST(t AS DATE) AS day, TRY_CAST(t AS TIMESTAMP) AS at
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'no date'
             WHEN o_orderkey % 11 <> 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS t FROM orders)""",
            "job_silver": "SELECT * FROM silver",
            "job_gold_fact": "SELECT * FROM fact_recent_changes",
            "job_checks": "\nUNION ALL ".join([
                _metric("bronze", "rows", "count(*)", "count(*) = 0", "bronze"),
                _metric("bronze", "duplicate_keys",
                        _dup_count("bronze", "kafka_topic, kafka_partition, kafka_offset"),
                        _dup_count("bronze", "kafka_topic, kafka_partition, kafka_offset") + " > 0"),
                _silver_checks(),
                _metric("quarantine", "rows", "count(*)", "false", "quarantine"),
                "SELECT 'quarantine', 'rows_' || coalesce(quality_error_category, 'none'), "
                "count(*), false FROM quarantine GROUP BY quality_error_category",
                _gold_checks(),
            ]),
            "checks_by_state": "\nUNION ALL ".join([
                _silver_checks(),
                _metric("quarantine", "rows", "count(*)", "false", "quarantine"),
                "SELECT 'quarantine', 'rows_' || coalesce(quality_error_category, 'none'), "
                "count(*), false FROM quarantine GROUP BY quality_error_category",
                _gold_checks(),
            ]),
            "kafka_publish": f"""
SELECT n AS event_id,
       CASE WHEN w <> '' AND t <> '' THEN w || ':' || t
            WHEN w <> '' THEN w
            WHEN m <> '' THEN m END AS key,
       value
FROM (
  SELECT n, value,
         json_extract_string(value, '$.wiki') AS w,
         json_extract_string(value, '$.title') AS t,
         json_extract_string(value, '$.meta.id') AS m
  FROM (SELECT n, CAST({PAYLOAD_SQL} AS VARCHAR) AS value FROM feed_src)
)""",
            "clean_text_pages": f"""
SELECT page_id, {clean_sql('html')} AS clean_html, {blank_to_null_sql('url')} AS clean_url,
       CAST(length({clean_sql('html')}) AS INTEGER) AS clean_length
FROM pages""",
            "dim_date_orders": """
SELECT date_key, event_date,
       CAST(year(event_date) AS INTEGER) AS year, CAST(quarter(event_date) AS INTEGER) AS quarter,
       CAST(month(event_date) AS INTEGER) AS month, CAST(day(event_date) AS INTEGER) AS day,
       CAST(dayofweek(event_date) + 1 AS INTEGER) AS day_of_week
FROM (SELECT DISTINCT CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
             CAST(o_orderdate AS DATE) AS event_date
      FROM orders WHERE o_orderdate IS NOT NULL)""",
            "duplicate_keys": f"""
SELECT 'orders.o_custkey' AS key, {_dup_count('orders', 'o_custkey')} AS duplicate_groups
UNION ALL SELECT 'events.user_id,event_type', {_dup_count('events', 'user_id, event_type')}
UNION ALL SELECT 'lineitem.l_orderkey,l_linenumber', {_dup_count('lineitem', 'l_orderkey, l_linenumber')}""",
            "null_counts_events": """
SELECT count(*) FILTER (WHERE event_id IS NULL) AS null_event_id,
       count(*) FILTER (WHERE ts IS NULL) AS null_ts,
       count(*) FILTER (WHERE user_id IS NULL) AS null_user_id,
       count(*) FILTER (WHERE event_type IS NULL) AS null_event_type,
       count(*) FILTER (WHERE value IS NULL) AS null_value,
       count(*) FILTER (WHERE props IS NULL) AS null_props
FROM events""",
            "events_by_window_raw": """
SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end,
       CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour,
       count(*) AS events
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2, 3, 4""",
            "events_props_json": """
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
            "lineitem_star_labels": """
SELECT coalesce(n.n_name, 'unknown') AS nation, coalesce(c.c_mktsegment, 'unknown') AS segment,
       count(*) AS line_items, round(sum(l.l_quantity), 2) AS quantity
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2""",
            "check_bronze": "\nUNION ALL ".join([
                _metric("bronze", "rows", "count(*)", "count(*) = 0", "bronze"),
                _metric("bronze", "duplicate_keys",
                        _dup_count("bronze", "kafka_topic, kafka_partition, kafka_offset"),
                        _dup_count("bronze", "kafka_topic, kafka_partition, kafka_offset") + " > 0"),
            ]),
            "check_silver": _silver_checks(),
            "check_quarantine": (
                _metric("quarantine", "rows", "count(*)", "false", "quarantine")
                + "\nUNION ALL SELECT 'quarantine', 'rows_' || coalesce(quality_error_category, 'none'), "
                "count(*), false FROM quarantine GROUP BY quality_error_category"
            ),
            "check_gold": _gold_checks(),
            "dashboard_readiness": _readiness_checks(),
            "serving_metric_cards": f"""
SELECT s.selected_events, k.total_events,
       CASE WHEN k.total_events = 0 THEN 0.0
            ELSE CAST(k.bot_events AS DOUBLE) / k.total_events * 100.0 END AS bot_share_pct,
       k.unique_users, k.unique_pages, f.freshness, f.freshness_detail
FROM (SELECT coalesce(first(events), 0) AS total_events, coalesce(first(bot_events), 0) AS bot_events,
             coalesce(first(unique_users), 0) AS unique_users,
             coalesce(first(unique_pages), 0) AS unique_pages FROM agg_dashboard_kpis) k,
     (SELECT CAST(coalesce(sum(events), 0) AS BIGINT) AS selected_events FROM agg_events_by_date
      WHERE event_date BETWEEN {ss} AND {se}) s,
     ({_freshness_sql('fresh_filtered')}) f""",
            "serving_readiness": f"""
SELECT 'Gold KPI table' AS "check", 'Ready' AS status, 'Loaded' AS detail
UNION ALL SELECT 'Recent event timestamp', freshness, freshness_detail FROM ({_freshness_sql('fresh_all')})
UNION ALL SELECT 'Latest event time',
       CASE WHEN latest_event IS NULL THEN 'Missing' ELSE 'Available' END,
       coalesce(CAST(latest_event AS VARCHAR), '') FROM fresh_all""",
            "serving_freshness": _freshness_sql("fresh_all"),
            "serving_events_by_date": (
                f"SELECT event_date, events FROM agg_events_by_date WHERE event_date BETWEEN {ss} AND {se}"
            ),
            "serving_events_by_window": (
                f"SELECT window_start, events FROM agg_events_by_window WHERE event_date BETWEEN {ss} AND {se}"
            ),
            "serving_top_pages": _top("agg_top_pages", ["page_title", "namespace"], C.TOP_N),
            "serving_top_users": _top("agg_top_users", ["event_user", "is_bot"], C.TOP_N),
            "serving_event_types": _top("agg_events_by_type", ["event_type"], C.TOP_N),
            "serving_wikis": _top("agg_events_by_wiki", ["wiki"], C.TOP_N),
            "serving_recent_events": f"""
SELECT event_datetime, event_type, wiki, page_title, event_user, is_bot, namespace, comment
FROM recent_in_range
ORDER BY event_datetime DESC NULLS LAST, event_type NULLS FIRST, wiki NULLS FIRST,
         page_title NULLS FIRST, event_user NULLS FIRST, is_bot NULLS FIRST,
         namespace NULLS FIRST, comment NULLS FIRST
LIMIT {C.RECENT_ROWS}""",
            "serving_date_bounds": f"""
SELECT coalesce(min(event_date), {AS_OF_DATE}) AS min_date,
       coalesce(max(event_date), {AS_OF_DATE}) AS max_date
FROM agg_events_by_date""",
            "serving_selected_events": (
                "SELECT CAST(coalesce(sum(events), 0) AS BIGINT) AS selected_events "
                f"FROM agg_events_by_date WHERE event_date BETWEEN {ss} AND {se}"
            ),
        }
    )
    sql["kafka_write"] = f"SELECT key, value FROM ({sql['kafka_publish']})"
    found = {name: _with(text) for name, text in sql.items()}
    # The feed with far-off seconds where the text time is unreadable.
    far = CTES.replace("CASE WHEN d <> 6 THEN CAST(floor", f"CASE WHEN d = 7 THEN {C.FAR_SECONDS} WHEN d <> 6 THEN CAST(floor")
    found["far_event_times"] = f"""WITH {far}
SELECT date_key, count(*) AS events FROM fact_recent_changes GROUP BY 1
UNION ALL SELECT NULL, count(*) FROM quarantine WHERE quality_error_category = 'invalid_event_timestamp'"""
    return found
