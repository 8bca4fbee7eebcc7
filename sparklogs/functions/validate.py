"""The last gate before storage: every field against its type, length, set and range."""

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed

_TEXT = {
    # field: (may be null, shortest, longest, allowed values)
    "client_ip": (True, None, None, None),
    "client_ip_hash": (True, None, None, None),
    "event_id": (False, 8, 64, None),
    "geo_country": (True, 2, 2, None),
    "geo_source": (False, None, None, fixed.GEO_SOURCES),
    "host": (False, 1, None, None),
    "http_method": (True, None, None, None),
    "ingested_at": (False, None, None, None),
    "log_level": (False, None, None, fixed.LEVELS),
    "message": (True, None, None, None),
    "path": (True, None, None, None),
    "path_group": (True, None, None, None),
    "referer": (True, None, None, None),
    "service": (False, 1, None, None),
    "source_format": (False, None, None, fixed.SOURCE_FORMATS),
    "trace_id": (True, None, None, None),
    "user_agent": (True, None, None, None),
}
_NUMBERS = {"response_bytes": (0, None), "response_time_ms": (0, None), "status_code": (100, 599)}


def first_problem(bad_types: str | None = None) -> Column:
    """`<field>: <problem>` of the first failing field in name order, or null when all is well.

    Column `bad_types` lists fields whose source value was not text. One CASE, so that nothing after
    the first failure is evaluated.
    """
    problems = []

    def reject(field: str, condition: str, text: str) -> None:
        problems.append(f"WHEN {condition} THEN '{field}: {text}'")

    for field in sorted([*_TEXT, *_NUMBERS, "timestamp"]):
        if field in _TEXT:
            nullable, shortest, longest, allowed = _TEXT[field]
            if bad_types:
                reject(field, f"array_contains({bad_types}, '{field}')", "is not text")
            if not nullable:
                reject(field, f"{field} IS NULL", "is missing")
            if shortest:
                reject(field, f"length({field}) < {shortest}", f"is shorter than {shortest}")
            if longest:
                reject(field, f"length({field}) > {longest}", f"is longer than {longest}")
            if allowed:
                quoted = ", ".join(f"'{value}'" for value in allowed)
                reject(field, f"{field} NOT IN ({quoted})", f"is not one of {', '.join(allowed)}")
        elif field in _NUMBERS:
            lowest, highest = _NUMBERS[field]
            reject(field, f"{field} < {lowest}", f"is less than {lowest}")
            if highest:
                reject(field, f"{field} > {highest}", f"is greater than {highest}")
        else:
            reject(field, f"{field} IS NULL", "is missing")
    return F.expr(f"CASE {' '.join(problems)} END")


def unknown_json_fields(text: Column, known: list[str]) -> Column:
    """Names in a JSON object that the record type does not have, in name order."""
    return F.array_sort(F.array_except(F.json_object_keys(text), F.array(*[F.lit(n) for n in known])))


def check_columns(frame: DataFrame, known: list[str]) -> DataFrame:
    """Refuse a frame with columns that the record type does not have."""
    surplus = sorted(set(frame.columns) - set(known))
    if surplus:
        raise ValueError(f"unknown field(s): {', '.join(surplus)}")
    return frame
