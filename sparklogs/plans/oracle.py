"""The projections of `fixtures.py` in SQL, as common table expressions."""

from .. import fixed
from .fixtures import BROKEN_LINES

_STAMP = "01/Jan/2024:00:00:00 +0000"


def _literal(text: str) -> str:
    parts, plain = [], ""
    for c in text:
        if ord(c) < 32 or ord(c) == 127:
            parts += [f"'{plain}'", f"chr({ord(c)})"]
            plain = ""
        else:
            plain += "''" if c == "'" else c
    return " || ".join([*parts, f"'{plain}'"])


_BROKEN = " ".join(
    f"WHEN {i} THEN {_literal(line.format(stamp=_STAMP))}" for i, line in enumerate(BROKEN_LINES)
)

PARSED = r"""
base AS (
  SELECT event_id AS id, user_id, event_type, value, ts, CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k
  FROM events
), statused AS (
  SELECT *, CAST(CASE WHEN event_type = 'error' THEN 500 + id % 4 WHEN event_type = 'click' THEN 304
    WHEN event_type = 'signup' THEN 201 WHEN id % 50 = 7 THEN 404 ELSE 200 END AS INTEGER) AS status_code
  FROM base
), parsed AS (
  SELECT id, 'event-id-' || id AS event_id, ts AS timestamp,
    make_timestamp(epoch_us(ts) + (id % 900) * 1000) AS ingested_at,
    make_timestamp(epoch_us(ts) + (id % 900 + id % 1700) * 1000) AS stored_at,
    'web-0' || (user_id % 6 + 1) AS host, 'svc-' || (user_id % 7) AS service, user_id, k,
    CASE id % 6 WHEN 0 THEN '10.0.' || (id // 6) % 256 || '.' || (id // 1536) % 256
      WHEN 1 THEN '8.8.' || (id // 6) % 256 || '.' || (id // 1536) % 256
      WHEN 2 THEN 'h' || id || '.example.jp' WHEN 3 THEN 'h' || id || '.example.com'
      WHEN 4 THEN 'h' || id || '.nasa.gov' END AS client_ip,
    CASE id % 5 WHEN 0 THEN '/' WHEN 1 THEN '/images/' || k || '.gif' WHEN 2 THEN '/shuttle/m/' || k
      WHEN 3 THEN '/search?q=a/' || k ELSE '/misc-' || k || '/x' END AS path,
    status_code, k * 512 AS response_bytes,
    CASE WHEN id % 11 <> 0 THEN CAST(floor(value * 10) AS BIGINT) END AS response_time_ms,
    CASE WHEN status_code >= 500 THEN 'ERROR' WHEN status_code >= 400 THEN 'WARN' ELSE 'INFO' END AS log_level,
    status_code >= 500 AS is_error
  FROM statused
)"""

DENSE = PARSED + r""",
dense AS (
  SELECT * REPLACE (make_timestamp(1704067200000000 + (id // 4) * 1000000) AS timestamp,
    (id % 250 = 0) OR (service = 'svc-3' AND id // 2000 = 2 AND id % 3 = 0) AS is_error)
  FROM parsed
)"""

LOG_LINES = PARSED + rf""",
log_lines AS (
  SELECT *, CASE WHEN id % 20 = 0 THEN CASE (id // 20) % {len(BROKEN_LINES)} {_BROKEN} END
    ELSE coalesce(client_ip, 'unknown') || ' - - [' || strftime(timestamp, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET '
      || path || ' HTTP/1.1" ' || CASE WHEN id % 97 = 5 THEN 700 ELSE status_code END || ' ' || response_bytes
      || CASE WHEN response_time_ms IS NULL THEN ''
         ELSE ' ' || response_time_ms // 1000 || '.' || lpad(CAST(response_time_ms % 1000 AS VARCHAR), 3, '0') END
    END AS raw_message,
    CASE WHEN id % 20 = 0 THEN CASE WHEN (id // 20) % {len(BROKEN_LINES)} = {len(BROKEN_LINES) - 1} THEN 'decode' ELSE 'parse' END
      WHEN id % 97 = 5 THEN 'validate' END AS stage
  FROM parsed
)"""

RAW_JSON = LOG_LINES + r""",
raw_json AS (
  SELECT * REPLACE (CASE WHEN id % 60 BETWEEN 31 AND 34 THEN 'decode' ELSE stage END AS stage) FROM log_lines
)"""

JSON_LINES = PARSED + r""",
json_lines AS (SELECT *, id % 40 = 1 AS cut, id % 25 = 0 AS untimed FROM parsed)"""

DUP = PARSED + r""",
dup AS (
  SELECT *, make_timestamp(epoch_us(stored_at) + copy * 1000000) AS processed_at
  FROM parsed, (VALUES (0), (1)) AS c(copy) WHERE copy = 0 OR id % 10 = 0
)"""

COUNTERS = r"""
minutes AS (SELECT event_type, date_trunc('minute', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2),
samples AS (
  SELECT event_type, ts, n, sum(n) OVER (
    PARTITION BY event_type, ts >= TIMESTAMP '2024-01-16 00:00:00' ORDER BY ts) AS value
  FROM minutes
)"""

OFFSETS = r"""
minutes AS (
  SELECT CAST(user_id % 6 AS INTEGER) AS partition, date_trunc('minute', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2
), positions AS (
  SELECT ts, partition, CAST(sum(n) OVER (PARTITION BY partition ORDER BY ts) AS BIGINT) AS latest,
    epoch_us(ts) // 60000000 AS idx
  FROM minutes
), offsets AS (
  SELECT ts, g AS consumergroup, partition, latest,
    greatest(0, latest - CASE WHEN g = 'store' THEN idx % 13 ELSE idx % 5 END) AS committed
  FROM positions, (VALUES ('parser'), ('store'), ('_internal')) AS x(g)
)"""

CHANGES = r"""
changes AS (
  SELECT page_id AS p, url,
    regexp_extract(url, '/([^/]*)$', 1) || ' é+*~' AS title,
    CASE page_id % 5 WHEN 0 THEN 'edit' WHEN 1 THEN 'new' WHEN 2 THEN 'log' WHEN 3 THEN 'categorize' ELSE 'other' END AS kind,
    CASE page_id % 4 WHEN 0 THEN 'Editor' || page_id % 50 WHEN 1 THEN '~2026-' || page_id % 40
      WHEN 2 THEN '198.51.100.' || page_id % 256 END AS usr,
    CASE WHEN page_id % 17 <> 0 THEN regexp_extract(url, '^https?://([^/]+)', 1) END AS server_name,
    CASE WHEN page_id % 5 <> 1 THEN 'wiki' || page_id % 9 END AS wiki,
    CASE page_id % 7 WHEN 0 THEN 'Reverted edit' WHEN 1 THEN '' WHEN 2 THEN repeat('long ', 150)
      WHEN 3 THEN 'plain words' WHEN 4 THEN 'undo 7' WHEN 5 THEN 'revertible' END AS comment,
    page_id % 3 = 0 AS bot, page_id % 8 <> 3 AS has_length, page_id % 12 <> 0 AS timed
  FROM pages
), mapped AS (
  SELECT *, CASE WHEN page_id_revert THEN 'WARN' WHEN bot THEN 'DEBUG' ELSE 'INFO' END AS level
  FROM (SELECT *, p % 7 IN (0, 4) AS page_id_revert FROM changes)
  WHERE coalesce(server_name, '') <> '' AND timed
)"""

# Trailing windows over 30-second panes, then states by gaps and islands. `evals` must come before.
def states(threshold: float, hold: int) -> str:
    return rf"""
bad AS (
  SELECT *, eval_s // {fixed.EVALUATE_SECONDS} - row_number() OVER (PARTITION BY service ORDER BY eval_s) AS run
  FROM evals WHERE value > {threshold}
), states AS (
  SELECT service, eval_s, value, held_seconds,
    CASE WHEN held_seconds >= {hold} THEN 'Firing' ELSE 'Pending' END AS state
  FROM (SELECT *, eval_s - min(eval_s) OVER (PARTITION BY service, run) AS held_seconds FROM bad)
  UNION ALL
  SELECT service, eval_s, value, 0, 'Normal' FROM evals WHERE NOT value > {threshold}
)"""


def pane(column: str = "timestamp", seconds: int = fixed.EVALUATE_SECONDS) -> str:
    micros = seconds * 1_000_000
    return f"((epoch_us({column}) + {micros - 1}) // {micros}) * {seconds}"
