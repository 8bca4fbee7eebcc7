"""What a raw line says about itself: time stamp, path, service, host, identity."""

from pyspark.sql import Column, functions as F

from .. import fixed
from . import jsonvalue as J
from .text import SPACE, SPACES, constant_map

_CLF_STAMP = r"(?s)^(.*?)\[\d{2}/[A-Za-z]{3}/\d{4}:\d{2}:\d{2}:\d{2}" rf"[{SPACE}]*(?:[+-]\d{{4}})?\]"
_REQUEST_PATH = rf'"[A-Z]+[{SPACE}]+([^{SPACE}]+)(?:[{SPACE}]+HTTP/[\d.]+)?"'


def rewrite_timestamp(line: Column, as_of: Column) -> Column:
    """Put `as_of` in place of the first bracketed access-log stamp; lines without one stay as they are."""
    stamp = F.date_format(as_of, "dd/MMM/yyyy:HH:mm:ss")
    return F.regexp_replace(line, F.lit(_CLF_STAMP), F.concat(F.lit("$1["), stamp, F.lit(" +0000]")))


def extract_path(line: Column) -> Column:
    """Path of the quoted request, `/` when there is none."""
    path = F.regexp_extract(line, _REQUEST_PATH, 1)
    return F.when(path == "", "/").otherwise(path)


def stable_index(text: Column, size: int) -> Column:
    """Bucket of a text: the first four bytes of its md5, modulo `size`. The same on every machine."""
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % size).cast("int")


def _pick(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in names]), index + 1)


def derive_service(path: Column) -> Column:
    """Service that owns the first path segment; unknown segments are spread over a fixed few."""
    segment = F.lower(F.regexp_extract(path, "^/*([^/?]*)", 1))
    return F.coalesce(
        F.when(segment == "", fixed.ROOT_SERVICE),
        F.try_element_at(constant_map(fixed.SERVICE_BY_SEGMENT), segment),
        _pick(fixed.FALLBACK_SERVICES, stable_index(segment, len(fixed.FALLBACK_SERVICES))),
    )


def derive_host(line: Column) -> Column:
    """One of the fixed hosts, chosen by the first token of the line."""
    client = F.regexp_extract(line, rf"^([^{SPACE}]+)", 1)
    client = F.when(client == "", "unknown").otherwise(client)
    return _pick(fixed.HOSTS, stable_index(client, len(fixed.HOSTS)))


def json_identity(parsed: Column, keys: list[str]) -> Column:
    """First truthy member among `keys` of `jsonvalue.members` output, if it is text or an integer."""
    value = J.first_truthy(parsed, keys)
    type_name = J.kind(value)
    return F.when(type_name.isin("STRING", "BIGINT"), J.text_of(value)).when(type_name == "BOOLEAN", "True")


def event_id(host: Column, service: Column, raw_message: Column) -> Column:
    """Identity from content, so that a line sent twice gets the same id. No argument may be null."""
    return F.substring(F.sha2(F.concat_ws("|", host, service, raw_message), 256), 1, 32)


def chop(line: Column) -> Column:
    """Cut line ends."""
    return F.rtrim(line, F.lit("\r\n"))


def is_blank(line: Column) -> Column:
    return F.coalesce(F.btrim(line, F.lit(SPACES)) == "", F.lit(True))
