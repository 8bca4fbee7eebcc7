"""Derived fields: country, path group, error flag, live-view class."""

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from .text import constant_map

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def ipv4_number(text: Column) -> Column:
    """Dotted IPv4 text as BIGINT; the text must match IPV4."""
    part = [F.split_part(text, F.lit("."), F.lit(i)).try_cast("bigint") for i in (1, 2, 3, 4)]
    return part[0] * (1 << 24) + part[1] * (1 << 16) + part[2] * (1 << 8) + part[3]


def _number(dotted: str) -> int:
    total = 0
    for octet in dotted.split("."):
        total = total * 256 + int(octet)
    return total


def _is_private_ipv4(number: str) -> Column:
    ranges = []
    for block in fixed.PRIVATE_IPV4:
        base, bits = block.split("/")
        first = _number(base)
        ranges.append(f"{number} BETWEEN {first} AND {first + (1 << (32 - int(bits))) - 1}")
    reachable = ", ".join(str(_number(dotted)) for dotted in fixed.GLOBAL_IPV4)
    return F.expr(f"({' OR '.join(ranges)}) AND {number} NOT IN ({reachable})")


def with_ipv6_digits(frame: DataFrame, text: Column, out: str) -> DataFrame:
    """Add `out`: the 32 hexadecimal digits of IPv6 text, null when it is not an IPv6 address.

    Done in steps, each a column, so that no step is repeated inside another.
    """
    columns = frame.columns
    bare = F.when(text.contains(":"), F.lower(F.regexp_replace(text, "%[^%]+$", "")))
    frame = frame.withColumn("_bare", bare)
    # A dotted tail counts as the last two groups.
    frame = frame.withColumn("_dotted", F.regexp_extract("_bare", r":(\d+\.\d+\.\d+\.\d+)$", 1))
    frame = frame.withColumn("_number", F.when(F.col("_dotted").rlike(IPV4), ipv4_number(F.col("_dotted"))))
    high, low = F.floor(F.col("_number") / 65536), F.pmod(F.col("_number"), F.lit(65536))
    frame = frame.withColumn("_plain", F.when(F.col("_dotted") == "", F.col("_bare")).otherwise(F.concat(
        F.regexp_replace("_bare", r"\d+\.\d+\.\d+\.\d+$", ""), F.lower(F.hex(high)), F.lit(":"), F.lower(F.hex(low))
    )))
    plain = F.col("_plain")
    has_gap = plain.contains("::")
    frame = frame.withColumns({
        "_left": F.split_part(plain, F.lit("::"), F.lit(1)),
        "_right": F.when(has_gap, F.split_part(plain, F.lit("::"), F.lit(2))).otherwise(""),
    })

    def count(part: str) -> Column:
        colons = F.length(part) - F.length(F.replace(F.col(part), F.lit(":"), F.lit("")))
        return F.when(F.col(part) == "", 0).otherwise(colons + 1)

    def padded(part: str) -> Column:
        # "1:ab" -> "0001:ab" -> "000100ab": pad every group with zeros, keep its last four digits.
        wide = F.regexp_replace(F.col(part), "([0-9a-f]+)", "000$1")
        return F.regexp_replace(F.regexp_replace(wide, "0*([0-9a-f]{4})(?=:|$)", "$1"), ":", "")

    frame = frame.withColumn("_gap", 8 - count("_left") - count("_right"))
    groups = r"[0-9a-f]{1,4}(?::[0-9a-f]{1,4})*"
    shaped = F.when(has_gap, plain.rlike(rf"^(?:{groups})?::(?:{groups})?$") & (F.col("_gap") >= 1)).otherwise(
        plain.rlike(rf"^{groups}$") & (F.col("_gap") == 0)
    )
    digits = F.concat(padded("_left"), F.repeat(F.lit("0000"), F.col("_gap")), padded("_right"))
    return frame.select(*columns, F.when(shaped, digits).alias(out))


def address_key(ipv4: Column, digits: Column) -> Column:
    """One text for addresses of both families, in the order of their numbers: 4 and 8 digits, or 6 and 32 digits."""
    return F.coalesce(F.concat(F.lit("4"), F.lower(F.lpad(F.hex(ipv4), 8, "0"))), F.concat(F.lit("6"), digits))


def with_geo(frame: DataFrame, client: Column, out: str = "_geo", address: str | None = None) -> DataFrame:
    """Add STRUCT<country, source> without a range table: private addresses and top-level domains only.

    A public address stays `unresolved` here; `address` names a column for its key, by which operators.lookup finds its
    network. Everything is built-in expressions, and those for IPv6 do work only for clients with a colon.
    """
    columns = frame.columns
    frame = with_ipv6_digits(frame.withColumn("_client", client), F.col("_client"), "_digits")
    client, digits = F.col("_client"), F.col("_digits")
    frame = frame.withColumn("_ipv4", F.when(client.rlike(IPV4), ipv4_number(client)))
    suffix = F.lower(F.substring_index(client, ".", -1))
    by_tld = F.try_element_at(constant_map(fixed.COUNTRY_BY_TLD), suffix)
    country = F.when(F.length(suffix) == 2, by_tld).when(
        suffix.isin(fixed.US_ONLY_TLDS), "US")
    private_ipv6 = digits.rlike(fixed.PRIVATE_IPV6) & ~digits.rlike(fixed.GLOBAL_IPV6)
    frame = frame.withColumn("_kind", (
        F.when(client.isNull() | (client == ""), "none")
        .when(F.col("_ipv4").isNotNull(), F.when(_is_private_ipv4("_ipv4"), "private").otherwise("public"))
        .when(digits.isNotNull(), F.when(private_ipv6, "private").otherwise("public"))
        .otherwise("name")
    ))
    frame = frame.withColumn("_country", F.when(F.col("_kind") == "name", country))
    source = F.when(F.col("_country").isNotNull(), "tld").when(F.col("_kind") == "private", "private").otherwise(
        "unresolved")
    public = F.when(F.col("_kind") == "public", address_key(F.col("_ipv4"), digits))
    return frame.select(*columns, F.struct(F.col("_country").alias("country"), source.alias("source")).alias(out),
                        *([public.alias(address)] if address else []))


def path_group(path: Column) -> Column:
    """`/` and the first segment, without a query; null unless the path starts with `/`."""
    return F.when(path.startswith("/"), F.concat(F.lit("/"), F.regexp_extract(path, "^/+([^/?]*)", 1)))


def is_error(status: Column, level: Column) -> Column:
    """Status of 500 or more, or level ERROR. FATAL alone is not an error."""
    return F.coalesce(status >= 500, F.lit(False)) | F.coalesce(level == "ERROR", F.lit(False))


def live_class(error_stage: Column, level: Column, error_flag: Column, status: Column) -> Column:
    """Class of a row in a live view; wider than `is_error`, for FATAL counts too."""
    name = F.upper(F.coalesce(level, F.lit("INFO")))
    bad = F.coalesce(error_flag, F.lit(False)) | name.isin("ERROR", "FATAL") | F.coalesce(status >= 500, F.lit(False))
    return (
        F.when(error_stage.isNotNull(), "dead_letter").when(bad, "error").when(name == "WARN", "warn").otherwise("info")
    )


def band(value: Column, name: str) -> Column:
    """green, yellow or red by the fixed thresholds of `name`, some of which have no yellow; null stays null."""
    yellow, red = fixed.BANDS[name]
    scale = F.when(value >= red, "red")
    if yellow is not None:
        scale = scale.when(value >= yellow, "yellow")
    return scale.when(value.isNotNull(), "green")
