"""The same queries as plain SQL over the same tables, for an independent check."""

from __future__ import annotations

# ---- shared relations ---------------------------------------------------

_TOPICS = """
src AS (
  SELECT event_id AS seq, ts, event_type, CAST(user_id % 3 AS INTEGER) AS part,
         'p' || (user_id % 4) AS placement_id, 'r' || event_id AS request_id,
         user_id || '-' || json_extract_string(props, '$.k') AS bid_id,
         CASE WHEN user_id % 10 <= 3 THEN '123' WHEN user_id % 10 <= 6 THEN '456'
              WHEN user_id % 10 = 7 THEN '789' ELSE 'u-' || user_id END AS user_idfv,
         epoch_us(ts) // 1000000 AS epoch
  FROM events),
requests AS (
  SELECT *, CASE user_idfv WHEN '123' THEN 'campaign1' WHEN '456' THEN 'campaign2'
                           WHEN '789' THEN NULL ELSE 'campaign_default' END AS campaign_id
  FROM src WHERE event_type IN ('view', 'signup', 'purchase')),
bid_topic AS (SELECT * FROM requests WHERE campaign_id IS NOT NULL),
imp_topic AS (SELECT * FROM src WHERE event_type IN ('click', 'error'))
"""

_FACTS = (
    _TOPICS
    + """,
bid_ranked AS (SELECT *, row_number() OVER (PARTITION BY bid_id ORDER BY seq) AS rn FROM bid_topic),
imp_ranked AS (SELECT *, row_number() OVER (PARTITION BY bid_id ORDER BY seq) AS rn FROM imp_topic),
bids AS (SELECT seq, bid_id, campaign_id, ts FROM bid_ranked WHERE rn = 1),
imps AS (SELECT seq, bid_id, ts FROM imp_ranked WHERE rn = 1),
attributed AS (
  SELECT i.bid_id, i.seq, i.ts, b.seq AS bid_seq, b.campaign_id, b.ts AS bid_ts
  FROM imps i LEFT JOIN bids b ON b.bid_id = i.bid_id)
"""
)

_DELTAS = (
    _FACTS
    + """,
deltas AS (
  SELECT campaign_id, ts, 1 AS b, 0 AS d, 0 AS u FROM bids
  UNION ALL
  SELECT COALESCE(campaign_id, 'UNKNOWN'), ts, 0,
         CASE WHEN bid_seq IS NULL THEN 0 ELSE 1 END, CASE WHEN bid_seq IS NULL THEN 1 ELSE 0 END
  FROM attributed)
"""
)

_LEDGER = (
    _FACTS
    + """,
ledger AS (
  SELECT bid_id, seq, ts AS known_ts, campaign_id, ts, 1 AS b, 0 AS d, 0 AS u FROM bids
  UNION ALL
  SELECT bid_id, seq, ts, campaign_id, ts, 0, 1, 0 FROM attributed WHERE bid_seq < seq
  UNION ALL
  SELECT bid_id, seq, ts, 'UNKNOWN', ts, 0, 0, 1 FROM attributed WHERE bid_seq IS NULL OR bid_seq > seq
  UNION ALL
  SELECT bid_id, bid_seq, bid_ts, 'UNKNOWN', ts, 0, 0, -1 FROM attributed WHERE bid_seq > seq
  UNION ALL
  SELECT bid_id, bid_seq, bid_ts, campaign_id, ts, 0, 1, 0 FROM attributed WHERE bid_seq > seq)
"""
)

_BROKEN = (
    _TOPICS
    + """,
valid AS (
  SELECT 'bid-requests' AS topic, 'bid' AS kind, part, seq, bid_id, ts, epoch, request_id, user_idfv,
         campaign_id, placement_id,
         '{"request_id":"' || request_id || '","bid_id":"' || bid_id || '","user_idfv":"' || user_idfv
           || '","campaign_id":"' || campaign_id || '","placement_id":"' || placement_id
           || '","timestamp":' || epoch || '}' AS good
  FROM bid_topic
  UNION ALL
  SELECT 'impressions', 'impression', part, seq, bid_id, ts, epoch, request_id, user_idfv,
         NULL, placement_id,
         '{"bid_id":"' || bid_id || '","campaign_id":"","user_idfv":"","timestamp":' || epoch || '}'
  FROM imp_topic),
records AS (
  SELECT *, CASE WHEN seq % 97 = 0 THEN '{"bid_id":"broken"'
                 WHEN seq % 89 = 0 THEN '{"timestamp":' || epoch || '}'
                 WHEN seq % 83 = 0 THEN replace(good, '"timestamp":' || epoch, '"timestamp":' || epoch || '000000')
                 WHEN seq % 79 = 0 THEN replace(good, '"timestamp":' || epoch, '"timestamp":9223372036854775807')
                 ELSE good END AS value,
         CASE WHEN seq % 97 = 0 THEN 'invalid_json' WHEN seq % 89 = 0 THEN 'missing_required'
              WHEN seq % 83 = 0 OR seq % 79 = 0 THEN 'bad_timestamp' END AS reason
  FROM valid),
accepted AS (SELECT *, date_trunc('second', ts) AS event_ts FROM records WHERE reason IS NULL),
first_accepted AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind, bid_id ORDER BY seq) AS rn FROM accepted)
  WHERE rn = 1)
"""
)

#: Greedy suppression: hop from each accepted event to the first one a day later.
_HOPS = """,
next_free AS (
  SELECT bid_id, seq, ts, row_number() OVER (PARTITION BY bid_id ORDER BY ts, seq) AS rn,
         min(ts) OVER (PARTITION BY bid_id ORDER BY ts
                       RANGE BETWEEN INTERVAL 24 HOUR FOLLOWING AND UNBOUNDED FOLLOWING) AS next_ts
  FROM billing),
accepted_billing AS (
  SELECT bid_id, seq, ts, next_ts FROM next_free WHERE rn = 1
  UNION ALL
  SELECT n.bid_id, n.seq, n.ts, n.next_ts
  FROM accepted_billing a JOIN next_free n ON n.bid_id = a.bid_id AND n.ts = a.next_ts)
"""

_LOG = """
log AS (
  SELECT event_id, ts, user_id || '-' || json_extract_string(props, '$.k') AS bid_id,
         CASE WHEN user_id % 2 = 0 THEN 'run-a' ELSE 'run-b' END AS run_id,
         CASE WHEN ts < TIMESTAMP '2024-01-09' THEN 'steady' WHEN ts < TIMESTAMP '2024-01-16' THEN 'burst1'
              WHEN ts < TIMESTAMP '2024-01-23' THEN 'burst2' ELSE 'recovery' END AS stage,
         CASE event_type WHEN 'view' THEN 'bid' WHEN 'click' THEN 'billing_matched'
              WHEN 'purchase' THEN 'billing_unknown' WHEN 'signup' THEN 'billing_duplicate'
              ELSE 'billing_invalid' END AS op,
         CASE WHEN event_type = 'error' AND k % 10 = 3 THEN 0 WHEN event_type = 'error' AND k % 10 = 1 THEN 500
              WHEN event_type = 'error' AND k % 10 = 5 THEN 302 WHEN event_type = 'error' THEN 400
              WHEN event_type = 'view' AND user_id % 10 = 7 THEN 204 ELSE 200 END AS status,
         event_type = 'error' AND k % 10 = 3 AS net, event_type = 'error' AND k % 20 = 3 AS timed_out,
         k % 3 AS retries, event_type = 'click' AND k % 10 = 0 AS delayed
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)),
counters AS (
  SELECT run_id, stage, min(ts) AS started_at, max(ts) AS ended_at, count(*) AS attempts,
         count(*) FILTER (WHERE NOT net AND status BETWEEN 200 AND 299) AS http_2xx,
         count(*) FILTER (WHERE NOT net AND status BETWEEN 400 AND 499) AS http_4xx,
         count(*) FILTER (WHERE NOT net AND status >= 500) AS http_5xx,
         count(*) FILTER (WHERE net) AS network_errors,
         count(*) FILTER (WHERE timed_out) AS timeout_errors,
         CAST(sum(retries) AS BIGINT) AS retries_total,
         count(*) FILTER (WHERE op = 'bid') AS bid_attempts,
         count(*) FILTER (WHERE op = 'bid' AND status = 200) AS bid_success,
         count(*) FILTER (WHERE op = 'bid' AND status = 204) AS nofill_count,
         count(*) FILTER (WHERE op <> 'bid') AS billing_attempts,
         count(*) FILTER (WHERE op <> 'bid' AND NOT net AND status BETWEEN 200 AND 299) AS billing_success_2xx,
         count(*) FILTER (WHERE op = 'billing_duplicate') AS duplicate_attempts,
         count(*) FILTER (WHERE op = 'billing_invalid') AS invalid_attempts
  FROM log GROUP BY run_id, stage),
points AS (
  SELECT run_id, stage, ts FROM log WHERE NOT net AND status NOT BETWEEN 300 AND 399
  UNION ALL SELECT run_id, stage, started_at FROM counters
  UNION ALL SELECT run_id, stage, ended_at FROM counters),
gaps AS (
  SELECT run_id, stage, max(gap) AS gap FROM (
    SELECT run_id, stage, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY run_id, stage ORDER BY ts)) AS gap
    FROM points)
  GROUP BY run_id, stage),
early AS (
  SELECT l.run_id, count(*) AS attempts, count(*) FILTER (WHERE net OR status >= 400) AS errors
  FROM log l JOIN counters c ON c.run_id = l.run_id AND c.stage = l.stage
  WHERE l.stage = 'recovery' AND l.ts <= c.started_at + INTERVAL {seconds} SECOND GROUP BY 1)
"""

_ORDERS = """
bids AS (SELECT o_orderkey AS bid_id, o_orderpriority AS campaign_id, CAST(o_orderdate AS TIMESTAMP) AS ts
         FROM orders WHERE o_orderstatus <> 'P'),
imps AS (SELECT l_orderkey AS bid_id, CAST(min(l_shipdate) AS TIMESTAMP) AS ts FROM lineitem GROUP BY 1),
deltas AS (
  SELECT campaign_id, ts, 1 AS b, 0 AS d, 0 AS u FROM bids
  UNION ALL
  SELECT COALESCE(b.campaign_id, 'UNKNOWN'), i.ts, 0,
         CASE WHEN b.bid_id IS NULL THEN 0 ELSE 1 END, CASE WHEN b.bid_id IS NULL THEN 1 ELSE 0 END
  FROM imps i LEFT JOIN bids b ON b.bid_id = i.bid_id)
"""

# ---- pieces of a query --------------------------------------------------

_SUMS = (
    "CAST(COALESCE(sum(b), 0) AS BIGINT) AS bid_requests, "
    "CAST(COALESCE(sum(d), 0) AS BIGINT) AS deduped_impressions, "
    "CAST(COALESCE(sum(u), 0) AS BIGINT) AS unknown_impressions"
)
_RATE = (
    "CASE WHEN bid_requests = 0 THEN CAST(0 AS DOUBLE) "
    "ELSE CAST(deduped_impressions AS DOUBLE) / CAST(bid_requests AS DOUBLE) END AS view_rate"
)
_NONZERO = "bid_requests <> 0 OR deduped_impressions <> 0 OR unknown_impressions <> 0"


def _with(relations: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{relations.strip()}\n{body.strip()}"


def _range(column: str, start: str, end: str) -> str:
    return f"{column} >= TIMESTAMP '{start}' AND {column} < TIMESTAMP '{end}'"


def _summary(start: str, end: str, source: str, rows: str) -> str:
    return (
        f"SELECT TIMESTAMP '{start}' AS from_ts, TIMESTAMP '{end}' AS to_ts, '{source}' AS source, *, {_RATE} "
        f"FROM (SELECT {_SUMS} FROM ({rows}))"
    )


def _campaigns(rows: str) -> str:
    return (
        f"SELECT *, {_RATE} FROM (SELECT campaign_id, {_SUMS} FROM ({rows}) GROUP BY campaign_id) "
        f"WHERE {_NONZERO} ORDER BY bid_requests DESC, campaign_id"
    )


def _series(resolution: str, first: str, last: str, rows: str) -> str:
    """Buckets from ``first`` up to, not including, ``last``."""
    return f"""
SELECT *, {_RATE} FROM (
  SELECT ts, {_SUMS} FROM (
    SELECT date_trunc('{resolution}', ts) AS ts, b, d, u FROM ({rows})
    UNION ALL
    SELECT unnest(range(TIMESTAMP '{first}', TIMESTAMP '{last}', INTERVAL 1 {resolution})), 0, 0, 0)
  GROUP BY ts)
ORDER BY ts"""


def _between(start: str, end: str) -> str:
    return f"SELECT * FROM deltas WHERE {_range('ts', start, end)}"


# Ranges. The aligned form is rounded outward to whole minutes.
WEEK = ("2024-01-05 00:00:00", "2024-01-12 00:00:00")
UNALIGNED = ("2024-01-16 06:06:59.9", "2024-01-16 23:20:15")
ALIGNED = ("2024-01-16 06:06:00", "2024-01-16 23:21:00")
DAYS_AND_MORE = ("2024-01-08 06:06:59.9", "2024-01-20 23:20:15")
DAYS_ALIGNED = ("2024-01-08 06:06:00", "2024-01-20 23:21:00")
HOURS = ("2024-01-05 10:00:30", "2024-01-05 14:20:15")
TEN_DAYS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
CUTOFF = "2024-01-16 06:06:59.9"
CUTOFF_MINUTE = "2024-01-16 06:06:00"
HALFWAY = "2024-01-16 00:00:00"
YEARS = ("1995-01-01 00:00:00", "2002-01-01 00:00:00")

_OVERLAP = (
    _between(TEN_DAYS[0], CUTOFF) + " UNION ALL " + _between(CUTOFF_MINUTE, TEN_DAYS[1])
)
_HALF = (
    "(SELECT max(seq) FROM (SELECT seq, ts FROM bid_topic UNION ALL SELECT seq, ts FROM imp_topic) "
    f"WHERE ts < TIMESTAMP '{HALFWAY}')"
)
_RAW_TOTALS = "sum(b) AS b, sum(d) AS d, sum(u) AS u"
_MINUTES = f"SELECT campaign_id, date_trunc('minute', ts) AS minute_ts, {_SUMS} FROM {{rows}} GROUP BY 1, 2"
_HORIZON = "2024-01-11 00:00:00"

ORACLE: dict[str, str] = {}

# ---- sources and sinks --------------------------------------------------

ORACLE["src_events"] = _with(
    _BROKEN,
    'SELECT topic, part AS "partition", seq AS "offset", seq, bid_id AS "key", good AS "value", '
    "ts AS arrival_ts FROM valid",
)
ORACLE["encode_events"] = _with(_BROKEN, 'SELECT topic, bid_id AS "key", good AS "value" FROM valid')
ORACLE["facts_bids"] = _with(
    _BROKEN,
    "SELECT bid_id, request_id, campaign_id, user_idfv, placement_id, event_ts, value AS raw_json, "
    "ts AS ingested_at, seq, CAST(event_ts AS DATE) AS event_date FROM first_accepted WHERE kind = 'bid'",
)
ORACLE["facts_impressions"] = _with(
    _BROKEN,
    "SELECT bid_id, event_ts, value AS raw_json, ts AS ingested_at, seq, CAST(event_ts AS DATE) AS event_date "
    "FROM first_accepted WHERE kind = 'impression'",
)
ORACLE["change_log"] = _with(
    _BROKEN,
    "SELECT seq, CASE kind WHEN 'bid' THEN 'bid_seen' ELSE 'impression_seen' END AS event_type, "
    "bid_id AS entity_id, event_ts, value AS payload FROM first_accepted",
)
ORACLE["replay_scan"] = _with(
    _BROKEN,
    'SELECT event_ts, request_id, bid_id, user_idfv, campaign_id, placement_id, epoch AS "timestamp" '
    f"FROM first_accepted WHERE kind = 'bid' AND event_ts >= TIMESTAMP '{HALFWAY}'",
)
ORACLE["replay_impressions"] = _with(
    _BROKEN,
    "SELECT event_ts, bid_id, '' AS campaign_id, '' AS user_idfv, epoch AS \"timestamp\" "
    f"FROM first_accepted WHERE kind = 'impression' AND event_ts >= TIMESTAMP '{HALFWAY}'",
)
ORACLE["change_log_replay"] = _with(
    _BROKEN, "SELECT seq, kind, bid_id, campaign_id, event_ts FROM first_accepted"
)
ORACLE["topic_sample"] = _with(
    _BROKEN,
    'SELECT topic, part AS "partition", seq AS "offset", good AS "value" FROM ('
    "SELECT *, row_number() OVER (PARTITION BY topic ORDER BY part, seq) AS rn FROM valid) WHERE rn <= 100",
)

# ---- decoding and requests ----------------------------------------------

ORACLE["decode_bids"] = _with(
    _BROKEN,
    "SELECT seq, request_id, bid_id, user_idfv, campaign_id, placement_id, event_ts "
    "FROM accepted WHERE kind = 'bid'",
)
ORACLE["decode_impressions"] = _with(
    _BROKEN, "SELECT seq, bid_id, event_ts FROM accepted WHERE kind = 'impression'"
)
ORACLE["quarantine"] = _with(
    _BROKEN,
    'SELECT topic, part AS "partition", seq AS "offset", seq, value, reason FROM records WHERE reason IS NOT NULL',
)
_CREATIVE = "CASE WHEN campaign_id IS NULL THEN NULL ELSE 'https://example.com/creative/' || campaign_id || '.png' END"
ORACLE["select_campaign"] = _with(
    _TOPICS, f"SELECT seq, user_idfv, campaign_id, {_CREATIVE} AS creative_url FROM requests"
)
ORACLE["bid_requests_decoded"] = _with(
    _TOPICS,
    "SELECT seq, CASE WHEN bad THEN '' ELSE user_idfv END AS user_idfv, CASE WHEN bad THEN '' ELSE placement_id END "
    "AS placement_id, CASE WHEN bad THEN 'malformed' WHEN campaign_id IS NULL THEN 'no_fill' ELSE 'filled' END AS outcome "
    "FROM (SELECT *, seq % 97 = 0 OR seq % 89 = 0 AS bad FROM requests)",
)
ORACLE["nofill_counts"] = _with(
    _TOPICS, "SELECT count(campaign_id) AS filled, count(*) - count(campaign_id) AS no_fill FROM requests"
)
ORACLE["bid_events"] = _with(
    _TOPICS,
    "SELECT sha256('request|requests|' || part || '|' || seq) AS request_id, "
    "sha256('bid|requests|' || part || '|' || seq) AS bid_id, user_idfv, campaign_id, placement_id, "
    f'epoch AS "timestamp", {_CREATIVE} AS creative_url, \'http://localhost:8080/v1/billing\' AS billing_url '
    "FROM bid_topic",
)
_BILLING = (
    _BROKEN
    + """,
billing AS (SELECT bid_id, seq, ts FROM records
            WHERE kind = 'impression' AND (reason IS NULL OR reason = 'bad_timestamp'))
"""
    + _HOPS
    + """,
outcomes AS (
  SELECT b.seq, b.bid_id, b.ts AS arrival_ts,
         CASE WHEN a.seq IS NULL THEN 'duplicate' ELSE 'accepted' END AS outcome
  FROM billing b LEFT JOIN accepted_billing a ON a.bid_id = b.bid_id AND a.seq = b.seq
  UNION ALL
  SELECT seq, '', ts, CASE reason WHEN 'invalid_json' THEN 'malformed' ELSE 'missing_id' END
  FROM records WHERE kind = 'impression' AND reason IN ('invalid_json', 'missing_required'))
"""
)
ORACLE["billing_outcomes"] = _with(_BILLING, "SELECT * FROM outcomes", recursive=True)
ORACLE["billed_impressions"] = _with(
    _BILLING,
    "SELECT bid_id, '' AS campaign_id, '' AS user_idfv, epoch_us(arrival_ts) // 1000000 AS \"timestamp\" "
    "FROM outcomes WHERE outcome = 'accepted'",
    recursive=True,
)
ORACLE["minute_keys"] = _with(
    _TOPICS,
    "SELECT strftime(ts, '%Y%m%d%H%M') AS minute_key, count(*) AS records "
    "FROM (SELECT ts FROM bid_topic UNION ALL SELECT ts FROM imp_topic) GROUP BY 1",
)

# ---- deduplication ------------------------------------------------------

ORACLE["dedup_bids"] = _with(_FACTS, "SELECT seq, bid_id, campaign_id, ts AS event_ts FROM bids")
ORACLE["dedup_impressions"] = _with(_FACTS, "SELECT seq, bid_id, ts AS event_ts FROM imps")
_SUPPRESSION = _TOPICS + ", billing AS (SELECT bid_id, seq, ts FROM imp_topic)" + _HOPS
ORACLE["billing_suppression_24h"] = _with(
    _SUPPRESSION,
    "SELECT b.bid_id, b.ts AS arrival_ts, b.seq, a.seq IS NOT NULL AS accepted "
    "FROM billing b LEFT JOIN accepted_billing a ON a.bid_id = b.bid_id AND a.seq = b.seq",
    recursive=True,
)
ORACLE["billing_suppression_hot"] = ORACLE["billing_suppression_24h"]
ORACLE["billing_suppression_ties"] = _with(
    _TOPICS
    + """,
coarse AS (SELECT bid_id, seq % 2 AS seq, date_trunc('day', ts) AS ts FROM imp_topic),
billing AS (SELECT *, row_number() OVER (PARTITION BY bid_id, ts, seq) AS copy FROM coarse)"""
    + _HOPS.replace("SELECT bid_id, seq, ts, row_number() OVER (PARTITION BY bid_id ORDER BY ts, seq) AS rn",
                    "SELECT bid_id, seq, ts, row_number() OVER (PARTITION BY bid_id ORDER BY ts, seq) AS rn, "
                    "row_number() OVER (PARTITION BY bid_id, ts ORDER BY seq) AS first_at")
           .replace("FROM billing),", "FROM billing),", 1)
           .replace("n.ts = a.next_ts)", "n.ts = a.next_ts AND n.first_at = 1)"),
    "SELECT b.bid_id, b.ts AS arrival_ts, CAST(b.seq AS BIGINT) AS seq, a.seq IS NOT NULL AND b.copy = 1 AS accepted "
    "FROM billing b LEFT JOIN accepted_billing a ON a.bid_id = b.bid_id AND a.seq = b.seq AND a.ts = b.ts",
    recursive=True,
)
ORACLE["stream_billing_suppression"] = _with(
    _SUPPRESSION, "SELECT bid_id, seq, ts AS arrival_ts FROM accepted_billing", recursive=True
)

# ---- attribution --------------------------------------------------------

ORACLE["matched_impressions"] = _with(
    _FACTS, "SELECT bid_id, ts AS event_ts, campaign_id FROM attributed WHERE bid_seq IS NOT NULL"
)
ORACLE["unknown_impressions"] = _with(
    _FACTS, "SELECT bid_id, ts AS event_ts FROM attributed WHERE bid_seq IS NULL"
)
ORACLE["attributed_impressions"] = _with(
    _FACTS,
    "SELECT bid_id, ts AS event_ts, COALESCE(campaign_id, 'UNKNOWN') AS campaign_id, "
    "bid_seq IS NOT NULL AS matched FROM attributed",
)
ORACLE["attributed_from_ledger"] = _with(
    _FACTS,
    "SELECT bid_id, ts AS event_ts, COALESCE(campaign_id, 'UNKNOWN') AS campaign_id, bid_seq IS NOT NULL AS matched "
    f"FROM attributed WHERE {_range('ts', *DAYS_AND_MORE)}",
)
ORACLE["unmatched_bids"] = _with(
    _FACTS,
    "SELECT bid_id, seq FROM bids WHERE bid_id NOT IN (SELECT bid_id FROM imps) ORDER BY seq LIMIT 100",
)
ORACLE["matched_bid_ids"] = _with(_FACTS, "SELECT bid_id FROM bids WHERE bid_id IN (SELECT bid_id FROM imps)")

# ---- exact range queries ------------------------------------------------

ORACLE["summary_exact"] = _with(_DELTAS, _summary(*UNALIGNED, "facts", _between(*UNALIGNED)))
ORACLE["by_campaign_exact"] = _with(_DELTAS, _campaigns(_between(*WEEK)))
ORACLE["by_campaign_from_facts"] = _with(_DELTAS, _campaigns(_between(*UNALIGNED)))
ORACLE["by_campaign_json"] = (
    "SELECT '{\"campaign_id\":\"' || campaign_id || '\",\"bid_requests\":' || bid_requests "
    "|| ',\"deduped_impressions\":' || deduped_impressions || ',\"unknown_impressions\":' || unknown_impressions "
    f"|| ',\"view_rate\":' || view_rate || '}}' AS value FROM ({ORACLE['by_campaign_exact']})"
)
ORACLE["bucketed_counts"] = _with(
    _DELTAS, f"SELECT date_trunc('hour', ts) AS ts, {_SUMS} FROM deltas GROUP BY 1"
)
ORACLE["timeseries_minute"] = _with(
    _DELTAS, _series("minute", "2024-01-05 10:00:00", "2024-01-05 14:21:00", _between(*HOURS))
)
ORACLE["timeseries_hour"] = _with(_DELTAS, _series("hour", *WEEK, _between(*WEEK)))
ORACLE["timeseries_day"] = _with(_DELTAS, _series("day", *TEN_DAYS, _between(*TEN_DAYS)))
ORACLE["series_spine"] = """
SELECT unnest(range(lo, CASE WHEN date_trunc('minute', hi) = hi THEN hi
                             ELSE date_trunc('minute', hi) + INTERVAL 1 MINUTE END, INTERVAL 1 MINUTE)) AS ts
FROM (SELECT date_trunc('minute', min(ts)) AS lo, max(ts) AS hi FROM events)"""
ORACLE["top_campaigns"] = _with(
    _DELTAS,
    f"SELECT * FROM ({_campaigns(_between(*WEEK))}) WHERE bid_requests > 0 "
    "ORDER BY bid_requests DESC, campaign_id LIMIT 8",
)

# ---- roll-ups -----------------------------------------------------------

ORACLE["minute_global"] = _with(
    _DELTAS, f"SELECT date_trunc('minute', ts) AS minute_ts, {_SUMS} FROM deltas GROUP BY 1"
)
ORACLE["minute_campaign"] = _with(_DELTAS, _MINUTES.format(rows="deltas"))
ORACLE["stream_minute_campaign"] = ORACLE["minute_campaign"]
ORACLE["rebuild_takes_over"] = ORACLE["minute_campaign"]
ORACLE["stream_levels"] = _with(
    _DELTAS,
    " UNION ALL ".join(
        f"SELECT '{r}' AS level, campaign_id, date_trunc('{r}', ts) AS minute_ts, {_SUMS} FROM deltas GROUP BY 1, 2, 3"
        for r in ("minute", "hour", "day")
    ),
)
_SUBJECTS = {
    "bids": ("bids", "1"), "impressions": ("imps", "1"), "bid_requests": ("deltas", "b"),
    "deduped_impressions": ("deltas", "d"), "unknown_impressions": ("deltas", "u"),
}
ORACLE["reconcile_stored"] = _with(
    _DELTAS,
    " UNION ALL ".join(
        f"SELECT '{subject}' AS subject, CAST(ts AS DATE) AS event_date, CAST(sum({n}) AS BIGINT) AS rows, TRUE AS ok "
        f"FROM {source} GROUP BY 2 HAVING sum({n}) <> 0"
        for subject, (source, n) in _SUBJECTS.items()
    ),
)
ORACLE["summary_cover"] = _with(_DELTAS, _summary(*DAYS_AND_MORE, "rollup", _between(*DAYS_ALIGNED)))
ORACLE["by_campaign_cover"] = _with(_DELTAS, _campaigns(_between(*DAYS_ALIGNED)))
ORACLE["timeseries_cover_hour"] = _with(
    _DELTAS, _series("hour", "2024-01-08 06:00:00", "2024-01-21 00:00:00", _between(*DAYS_ALIGNED))
)
ORACLE["lifetime_global"] = _with(_DELTAS, f"SELECT {_SUMS} FROM deltas")
ORACLE["lifetime_campaign"] = _with(_LEDGER, f"SELECT campaign_id, {_SUMS} FROM ledger GROUP BY 1")
ORACLE["lifetime_from_store"] = _with(
    _DELTAS, f"SELECT campaign_id, {_SUMS} FROM deltas GROUP BY 1"
)
ORACLE["stream_retention"] = _with(
    _DELTAS, _MINUTES.format(rows=f"(SELECT * FROM deltas WHERE ts >= TIMESTAMP '{HALFWAY}')")
)
ORACLE["campaign_registry"] = _with(_LEDGER, "SELECT DISTINCT campaign_id FROM ledger ORDER BY 1")
ORACLE["summary_rollup"] = _with(_DELTAS, _summary(*UNALIGNED, "rollup", _between(*ALIGNED)))
ORACLE["by_campaign_rollup"] = _with(_DELTAS, _campaigns(_between(*ALIGNED)))
ORACLE["timeseries_rollup_hour"] = _with(
    _DELTAS, _series("hour", "2024-01-16 06:00:00", "2024-01-17 00:00:00", _between(*ALIGNED))
)
ORACLE["timeseries_rollup_day"] = _with(_DELTAS, _series("day", *TEN_DAYS, _between(*TEN_DAYS)))
ORACLE["freshness"] = _with(_LEDGER, "SELECT max(known_ts) AS last_projected_at FROM ledger")
ORACLE["rebuild_minutes"] = _with(
    _DELTAS, _MINUTES.format(rows=f"(SELECT * FROM deltas WHERE ts >= TIMESTAMP '{_HORIZON}')")
)
ORACLE["rebuild_minutes_recent_bids"] = _with(
    _FACTS
    + f""",
recent AS (
  SELECT campaign_id, ts, 1 AS b, 0 AS d, 0 AS u FROM bids WHERE ts >= TIMESTAMP '{_HORIZON}'
  UNION ALL
  SELECT CASE WHEN bid_ts >= TIMESTAMP '{_HORIZON}' THEN campaign_id ELSE 'UNKNOWN' END, ts, 0,
         CASE WHEN bid_ts >= TIMESTAMP '{_HORIZON}' THEN 1 ELSE 0 END,
         CASE WHEN bid_ts >= TIMESTAMP '{_HORIZON}' THEN 0 ELSE 1 END
  FROM attributed WHERE ts >= TIMESTAMP '{_HORIZON}')
""",
    _MINUTES.format(rows="recent"),
)
ORACLE["rollup_multires"] = _with(
    _DELTAS,
    " UNION ALL ".join(
        f"SELECT '{r}' AS resolution, campaign_id, date_trunc('{r}', ts) AS bucket_ts, {_SUMS} "
        "FROM deltas GROUP BY 1, 2, 3"
        for r in ("second", "minute", "hour", "day")
    ),
)
ORACLE["retention_impressions"] = _with(
    _FACTS, "SELECT seq, bid_id, ts AS event_ts FROM imps WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'"
)
ORACLE["counter_parse"] = """
SELECT event_id, CASE WHEN regexp_matches(text, '^[+-]?[0-9]+$') THEN coalesce(TRY_CAST(text AS BIGINT), 0) ELSE 0 END AS counter
FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN json_extract_string(props, '$.k') WHEN 1 THEN event_type
                                         WHEN 2 THEN '-' || event_id WHEN 3 THEN '99999999999999999999' END AS text FROM events)"""
ORACLE["retention_filter"] = _with(
    _FACTS,
    "SELECT seq, bid_id, campaign_id, ts AS event_ts FROM bids WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'",
)

# ---- routed and mixed queries -------------------------------------------

_BEFORE = ("2024-01-09 06:06:59.9", CUTOFF)
_ACROSS = ("2024-01-12 18:06:59.9", "2024-01-19 18:06:59.9")
_AFTER = (CUTOFF, "2024-01-23 06:06:59.9")
ORACLE["summary_routed"] = _with(
    _DELTAS,
    " UNION ALL ".join(
        [
            _summary(*_BEFORE, "facts", _between(*_BEFORE)),
            _summary(
                *_ACROSS,
                "mixed",
                _between(_ACROSS[0], CUTOFF_MINUTE)
                + " UNION ALL "
                + _between(CUTOFF_MINUTE, "2024-01-19 18:07:00"),
            ),
            _summary(*_AFTER, "rollup", _between(CUTOFF_MINUTE, "2024-01-23 06:07:00")),
        ]
    ),
)
ORACLE["summary_mixed"] = _with(_DELTAS, _summary(*TEN_DAYS, "mixed", _between(*TEN_DAYS)))
ORACLE["summary_mixed_compat"] = _with(_DELTAS, _summary(*TEN_DAYS, "mixed", _OVERLAP))
ORACLE["by_campaign_mixed"] = _with(_DELTAS, _campaigns(_between(*TEN_DAYS)))
ORACLE["timeseries_mixed_disjoint"] = _with(_DELTAS, _series("hour", *TEN_DAYS, _between(*TEN_DAYS)))
ORACLE["timeseries_mixed"] = _with(_DELTAS, _series("hour", *TEN_DAYS, _OVERLAP))

# ---- corrections --------------------------------------------------------

ORACLE["correction_ledger"] = _with(
    _LEDGER,
    "SELECT bid_id, seq, known_ts, campaign_id, ts AS event_ts, CAST(b AS BIGINT) AS bid_requests, "
    "CAST(d AS BIGINT) AS deduped_impressions, CAST(u AS BIGINT) AS unknown_impressions FROM ledger",
)
ORACLE["stream_correction_ledger"] = ORACLE["correction_ledger"]
ORACLE["stream_bounded_state"] = ORACLE["correction_ledger"]
ORACLE["read_model_as_of"] = _with(_LEDGER, _campaigns(f"SELECT * FROM ledger WHERE seq <= {_HALF}"))
ORACLE["as_of_from_store"] = ORACLE["read_model_as_of"]
ORACLE["read_model_growth"] = _with(
    _LEDGER
    + f", daily AS (SELECT date_trunc('day', known_ts) AS known_ts, {_RAW_TOTALS} FROM ledger GROUP BY 1)",
    "SELECT known_ts, CAST(sum(b) OVER (ORDER BY known_ts) AS BIGINT) AS bid_requests, "
    "CAST(sum(d) OVER (ORDER BY known_ts) AS BIGINT) AS deduped_impressions, "
    "CAST(sum(u) OVER (ORDER BY known_ts) AS BIGINT) AS unknown_impressions FROM daily",
)
ORACLE["backlog"] = _with(_BROKEN, f"SELECT count(*) AS pending FROM first_accepted WHERE seq > {_HALF}")
ORACLE["unknown_after_wait"] = _with(
    _FACTS
    + """,
judged AS (
  SELECT *, COALESCE(bid_ts <= ts + INTERVAL 24 HOUR AND bid_ts >= ts - INTERVAL 31 DAY, FALSE) AS ok
  FROM attributed)
""",
    "SELECT bid_id, CASE WHEN ok THEN campaign_id ELSE 'UNKNOWN' END AS campaign_id, ts AS event_ts, "
    "CASE WHEN ok THEN 'matched' ELSE 'unknown' END AS outcome FROM judged",
)

# ---- reconciliation -----------------------------------------------------

_OFFSETS = (
    _BROKEN
    + """,
numbered AS (SELECT topic, part, row_number() OVER (PARTITION BY topic, part ORDER BY seq) - 1 AS pos FROM valid),
offsets AS (SELECT topic, part, min(pos) AS earliest, max(pos) + 1 AS latest FROM numbered GROUP BY 1, 2),
counts AS (SELECT topic, CAST(sum(greatest(latest - earliest, 0)) AS BIGINT) AS messages FROM offsets GROUP BY 1)
"""
)
ORACLE["topic_counts"] = _with(_OFFSETS, "SELECT * FROM counts")
ORACLE["topic_thresholds"] = _with(
    _OFFSETS,
    "SELECT topic, messages, CAST(10001 AS BIGINT) AS threshold, "
    "CASE WHEN messages >= 10001 THEN 'PASS' ELSE 'FAIL' END AS status FROM counts",
)
ORACLE["reconcile_layers"] = _with(
    _DELTAS
    + """,
n AS (
  SELECT (SELECT count(*) FROM bid_topic) AS bid_rows, (SELECT count(*) FROM imp_topic) AS imp_rows,
         (SELECT count(*) FROM bids) AS bid_facts, (SELECT count(*) FROM imps) AS imp_facts,
         (SELECT CAST(sum(b) AS BIGINT) FROM deltas) AS b, (SELECT CAST(sum(d) AS BIGINT) FROM deltas) AS d,
         (SELECT CAST(sum(u) AS BIGINT) FROM deltas) AS u),
checks AS (
  SELECT 'bid facts = distinct topic bids' AS "check", bid_facts AS expected, bid_facts AS actual FROM n
  UNION ALL SELECT 'impression facts = distinct topic impressions', imp_facts, imp_facts FROM n
  UNION ALL SELECT 'bid rows >= bid facts', bid_rows, greatest(bid_rows, bid_facts) FROM n
  UNION ALL SELECT 'impression rows >= impression facts', imp_rows, greatest(imp_rows, imp_facts) FROM n
  UNION ALL SELECT 'backlog is empty', 0, 0
  UNION ALL SELECT 'roll-up bids = bid facts', bid_facts, b FROM n
  UNION ALL SELECT 'matched + unknown = impression facts', imp_facts, d + u FROM n
  UNION ALL SELECT 'summary bid_requests = roll-up', b, b FROM n
  UNION ALL SELECT 'summary deduped_impressions = roll-up', d, d FROM n
  UNION ALL SELECT 'summary unknown_impressions = roll-up', u, u FROM n)
""",
    'SELECT "check", CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual, '
    "expected = actual AS ok FROM checks",
)
_HALF_AND_WHOLE = (
    _LEDGER
    + f""",
half AS (SELECT campaign_id, {_SUMS} FROM ledger WHERE seq <= {_HALF} GROUP BY 1),
whole AS (SELECT campaign_id, {_SUMS} FROM ledger GROUP BY 1)
"""
)
ORACLE["snapshot_diff"] = _with(
    _HALF_AND_WHOLE,
    "SELECT *, 'left_only' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM half EXCEPT SELECT * FROM whole) "
    "UNION ALL "
    "SELECT *, 'right_only', 1 FROM (SELECT * FROM whole EXCEPT SELECT * FROM half)",
)
ORACLE["snapshot_delta"] = _with(
    _HALF_AND_WHOLE,
    "SELECT w.campaign_id, "
    + ", ".join(
        f"COALESCE(h.{c}, 0) AS {c}_before, w.{c} AS {c}_after, w.{c} - COALESCE(h.{c}, 0) AS {c}_delta"
        for c in ("bid_requests", "deduped_impressions", "unknown_impressions")
    )
    + " FROM whole w LEFT JOIN half h ON h.campaign_id = w.campaign_id",
)

# ---- request log --------------------------------------------------------

_MINUTE_LOG = _LOG.format(seconds=60)
_STAGE_RATES = """
  CAST(http_2xx AS DOUBLE) / attempts AS success_rate,
  CAST(http_4xx + http_5xx + network_errors AS DOUBLE) / attempts AS error_rate,
  CAST(network_errors AS DOUBLE) / attempts AS network_error_rate"""
ORACLE["stage_counters"] = _with(
    _MINUTE_LOG,
    f"SELECT *, (epoch_us(ended_at) - epoch_us(started_at)) // 1000 AS duration_ms, {_STAGE_RATES} FROM counters",
)
ORACLE["first_minute_error_rate"] = _with(
    _MINUTE_LOG,
    "SELECT run_id, 'recovery' AS stage, attempts, errors, CASE WHEN attempts = 0 THEN CAST(0 AS DOUBLE) "
    "ELSE CAST(errors AS DOUBLE) / attempts END AS first_minute_error_rate FROM early",
)
ORACLE["response_gaps"] = _with(
    _MINUTE_LOG,
    "SELECT run_id, stage, gap // 1000 AS max_no_response_gap_ms, gap > 10000000 AS long_no_response_gt_10s FROM gaps",
)
ORACLE["burst_slo"] = _with(
    _MINUTE_LOG
    + f""",
rates AS (SELECT c.run_id, c.stage, {_STAGE_RATES}, g.gap > 10000000 AS long_gap
          FROM counters c JOIN gaps g ON g.run_id = c.run_id AND g.stage = c.stage),
answer AS (
  SELECT run_id, max(CASE WHEN stage = 'burst1' THEN success_rate >= 0.98 AND network_error_rate < 0.01 AND NOT long_gap END)
           AS burst1_pass,
         max(CASE WHEN stage = 'burst2' THEN success_rate >= 0.98 AND network_error_rate < 0.01 AND NOT long_gap END)
           AS burst2_pass,
         max(CASE WHEN stage = 'steady' THEN error_rate END) AS steady_error_rate,
         max(CASE WHEN stage = 'recovery' THEN error_rate END) AS overall
  FROM rates GROUP BY run_id),
with_recovery AS (
  SELECT answer.run_id, burst1_pass, burst2_pass, steady_error_rate,
         CASE WHEN errors = 0 THEN overall ELSE CAST(errors AS DOUBLE) / attempts END AS recovery_error_rate
  FROM answer JOIN early ON early.run_id = answer.run_id)
""",
    "SELECT *, abs(recovery_error_rate - steady_error_rate) <= 0.005 AS recovery_pass, "
    "burst1_pass AND burst2_pass AND abs(recovery_error_rate - steady_error_rate) <= 0.005 AS burst_slo_met "
    "FROM with_recovery",
)
_OK = "NOT net AND status BETWEEN 200 AND 299"
ORACLE["load_totals"] = _with(
    _MINUTE_LOG
    + f""",
totals AS (
  SELECT run_id, count(*) AS attempts, count(*) FILTER (WHERE op = 'bid') AS bid_attempts,
         count(*) FILTER (WHERE op = 'bid' AND status = 200) AS bid_success,
         count(*) FILTER (WHERE op <> 'bid') AS billing_attempts_total,
         count(*) FILTER (WHERE op <> 'bid' AND {_OK}) AS billing_success_2xx,
         count(*) FILTER (WHERE NOT net AND status BETWEEN 400 AND 499) AS http_4xx,
         count(*) FILTER (WHERE NOT net AND status >= 500) AS http_5xx,
         count(*) FILTER (WHERE net) AS network_errors, CAST(sum(retries) AS BIGINT) AS retries_total,
         count(*) FILTER (WHERE op = 'bid' AND status = 204) AS nofill_count,
         count(*) FILTER (WHERE op = 'billing_duplicate') AS duplicate_attempts,
         count(*) FILTER (WHERE op = 'billing_invalid') AS invalid_attempts,
         count(*) FILTER (WHERE op = 'billing_matched' AND delayed AND {_OK}) AS delayed_billing_count,
         count(DISTINCT bid_id) FILTER (WHERE op = 'billing_matched' AND {_OK}) AS matched_unique,
         count(DISTINCT bid_id) FILTER (WHERE op = 'billing_unknown' AND {_OK}) AS unknown_unique,
         (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS duration_ms
  FROM log GROUP BY run_id)
""",
    "SELECT *, bid_success >= 15000 AND matched_unique >= 12000 AND unknown_unique >= 1000 "
    "AND duplicate_attempts >= 1000 AND nofill_count >= 1000 AND invalid_attempts >= 200 AS targets_met FROM totals",
)

# ---- orders as bids, line items as impressions --------------------------

ORACLE["orders_summary"] = _with(_ORDERS, _summary(*YEARS, "facts", _between(*YEARS)))
ORACLE["orders_by_campaign"] = _with(_ORDERS, _campaigns("SELECT * FROM deltas"))
ORACLE["orders_series_day"] = _with(_ORDERS, _series("day", *YEARS, _between(*YEARS)))
