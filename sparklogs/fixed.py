"""Fixed values. Results depend on every entry here, so none may be changed freely."""

# ---- intake ---------------------------------------------------------------------------------
# First path segment -> service that owns it.
SERVICE_BY_SEGMENT = {
    "shuttle": "shuttle-api",
    "images": "image-service",
    "icons": "image-service",
    "history": "history-api",
    "software": "software-api",
    "facilities": "facilities-api",
    "payloads": "payload-api",
    "biomed": "biomed-api",
    "elv": "launch-api",
    "procurement": "procurement-api",
    "persons": "directory-api",
    "htbin": "search-api",
    "cgi-bin": "search-api",
    "finance": "finance-api",
    "msfc": "portal-web",
    "ksc.html": "portal-web",
}
ROOT_SERVICE = "portal-web"
FALLBACK_SERVICES = ["portal-web", "search-api", "media-service"]
HOSTS = ["web-01", "web-02", "web-03", "web-04", "web-05", "web-06"]
REQUIRED_RAW_FIELDS = ["event_id", "host", "service", "source_format", "raw_message"]
SOURCE_FORMATS = ["nginx_combined", "json_app"]

# ---- JSON application logs: names a field may go by, in order of preference -----------------
TIMESTAMP_KEYS = ["timestamp", "time", "@timestamp", "ts", "eventTime"]
MESSAGE_KEYS = ["message", "msg", "log", "event"]
LEVEL_KEYS = ["level", "severity", "loglevel", "log_level"]
STATUS_KEYS = ["status_code", "status", "http_status", "statusCode"]
METHOD_KEYS = ["http_method", "method", "verb"]
PATH_KEYS = ["path", "url", "uri", "request_path"]
CLIENT_KEYS = ["client_ip", "ip", "remote_addr", "clientIp"]
DURATION_MS_KEYS = ["response_time_ms", "duration_ms", "latency_ms", "elapsed_ms"]
DURATION_S_KEYS = ["response_time", "duration", "request_time", "elapsed"]
TRACE_KEYS = ["trace_id", "traceId", "traceID", "correlation_id"]
BYTES_KEYS = ["response_bytes", "bytes", "bytes_sent", "content_length"]
SERVICE_KEYS = ["service", "service_name", "app"]
HOST_KEYS = ["host", "hostname", "node"]

LEVELS = ["TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL"]
LEVEL_SYNONYMS = {"WARNING": "WARN", "CRITICAL": "FATAL", "ERR": "ERROR"}

# ---- geography ------------------------------------------------------------------------------
COUNTRY_BY_TLD = {
    "au": "AU", "at": "AT", "be": "BE", "br": "BR", "ca": "CA", "ch": "CH",
    "cl": "CL", "cn": "CN", "cz": "CZ", "de": "DE", "dk": "DK", "ee": "EE",
    "es": "ES", "fi": "FI", "fr": "FR", "gr": "GR", "hk": "HK", "hu": "HU",
    "id": "ID", "ie": "IE", "il": "IL", "in": "IN", "is": "IS", "it": "IT",
    "jp": "JP", "kr": "KR", "lu": "LU", "mx": "MX", "my": "MY", "nl": "NL",
    "no": "NO", "nz": "NZ", "pl": "PL", "pt": "PT", "ro": "RO", "ru": "RU",
    "se": "SE", "sg": "SG", "si": "SI", "sk": "SK", "th": "TH", "tr": "TR",
    "tw": "TW", "ua": "UA", "uk": "GB", "us": "US", "za": "ZA",
}
US_ONLY_TLDS = ["edu", "gov", "mil"]
GEO_SOURCES = ["maxmind", "tld", "private", "unresolved"]

# IPv4 blocks without a geography (IANA special-purpose registry), and the two addresses inside
# 192.0.0.0/24 that the registry marks as globally reachable.
PRIVATE_IPV4 = [
    "0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12",
    "192.0.0.0/24", "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15",
    "198.51.100.0/24", "203.0.113.0/24", "240.0.0.0/4",
]
GLOBAL_IPV4 = ["192.0.0.9", "192.0.0.10"]

# The same for IPv6, as patterns over the 32 hexadecimal digits of an address.
PRIVATE_IPV6 = (
    "^(?:[014-9a-e]"        # outside 2000::/3: reserved by the IETF, loopback, mapped addresses
    "|f[0-9a-d]"            # f000::/5, f800::/6 reserved, fc00::/7 unique local
    "|fe[0-9ab]"            # fe00::/9 reserved, fe80::/10 link local
    "|200100|200101"        # 2001::/23
    "|20010db8"             # 2001:db8::/32 documentation
    "|2002"                 # 2002::/16 6to4
    "|3fff0)"               # 3fff::/20 documentation
)
GLOBAL_IPV6 = (
    "^(?:200100010{23}[12]$"  # 2001:1::1, 2001:1::2
    "|20010003"               # 2001:3::/32
    "|200100040112"           # 2001:4:112::/48
    "|2001002|2001003)"       # 2001:20::/28, 2001:30::/28
)

# ---- redaction ------------------------------------------------------------------------------
EMAIL_MARK = "[email]"
CREDENTIAL_MARK = "[redacted-credential]"
NUMBER_MARK = "[redacted-number]"

# ---- dead letters ---------------------------------------------------------------------------
ERROR_STAGES = ["decode", "parse", "enrich", "validate", "produce"]

# ---- page-edit feed -------------------------------------------------------------------------
REVERT_WORDS = ["revert", "reverted", "undo", "undid", "rollback", "rvv"]
STATUS_BY_CHANGE = {"edit": 200, "new": 201, "log": 204, "categorize": 304}

# ---- metrics, alerts, retention -------------------------------------------------------------
EVENT_SECONDS_BOUNDS = [0.0001, 0.00025, 0.0005, 0.001, 0.0025, 0.005, 0.01, 0.05, 0.1]
BATCH_SECONDS_BOUNDS = [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
INGEST_LAG_BOUNDS = [0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0]

# Threshold bands: values from the first number up are yellow (None: no yellow), from the second up red.
BANDS = {
    "error_pct": (1, 5), "lag": (10_000, 100_000), "dlq_rate": (1, 10), "ingest_lag_seconds": (None, 10), "error_pct_line": (None, 5),
}

EVALUATE_SECONDS = 30
ERROR_RATE_RULE = {"rule": "error-rate", "threshold": 5.0, "window_seconds": 300, "min_rows": 20, "hold_seconds": 60}
LAG_RULE = {"rule": "consumer-lag", "threshold": 50_000, "window_seconds": 300, "hold_seconds": 180}
DLQ_RULE = {"rule": "dlq-rate", "threshold": 5.0, "window_seconds": 300, "hold_seconds": 120}

RETENTION_HOURS = {
    "raw": 24, "parsed": 7 * 24, "errors": 14 * 24, "dead_letters": 30 * 24, "service_metrics_1m": 3 * 24,
}
HOT_DAYS = 7
STREAM_PARTITIONS = 6
LIVE_EVENTS_PER_SECOND = 200
LIVE_QUEUE = 256
ROLLING_RESPONSES = 50
