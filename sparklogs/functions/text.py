"""Text helpers whose notion of whitespace, word and time text does not depend on the JVM version."""

from pyspark.sql import Column, functions as F

# Unicode whitespace, spelled out: the short class `\s` covers only ASCII.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The same for text known to be ASCII; single characters make the fastest class.
ASCII_SPACE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f "
WORD = r"\p{L}\p{N}_"
# Word boundary over Unicode letters and digits.
EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"

_ISO_USUAL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})?$"
_ISO_ANY = (
    r"^(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2}))"
    r"(?:[\s\S](?:(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?)?|(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?)"
    r"(?:(Z|[+-]\d{2})(?::?(\d{2}))?)?)?$"
)
_ISO_PARTS = "$1$4-$2$5-$3$6 $7$11:$8$12:$9$13.$10$14|$15:$16"
_ISO_GAPS = [
    (" :", " 00:"), (":(?=[:.])", ":00"), (r"\.\|", ".0|"), (r"\|Z?:$", "+00:00"), (r"\|([+-]\d{2}):$", "$1:00"),
    (r"\|", ""),
]


def constant_map(entries: dict[str, str | int]) -> Column:
    """A map of constants, built in one expression."""
    def literal(value) -> str:
        return str(value) if isinstance(value, int) else f"'{value}'"

    return F.expr("map(" + ", ".join(f"{literal(k)}, {literal(v)}" for k, v in entries.items()) + ")")


def strip(text: Column) -> Column:
    """Cut Unicode whitespace from both ends."""
    return F.btrim(text, F.lit(SPACES))


def is_ascii(text: Column) -> Column:
    return F.length(text) == F.octet_length(text)


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP; no zone means UTC; anything else is null.

    The usual spelling is cast as it is. Basic spellings (`20260730T101532`), comma fractions, short
    times and short offsets are first rewritten to it.
    """
    text = strip(text)
    # A day with a zone of Z alone is its midnight.
    bare = F.regexp_replace(text, "^([0-9-]{8,10})Z$", "$1")
    parts = F.regexp_replace(bare, _ISO_ANY, _ISO_PARTS)
    # Empty fields are zero: "2026-07-30 10::.|:" is ten o'clock UTC.
    for pattern, filled in _ISO_GAPS:
        parts = F.regexp_replace(parts, pattern, filled)
    return F.when(text.rlike(_ISO_USUAL), text.try_cast("timestamp")).when(
        bare.rlike(_ISO_ANY), parts.try_cast("timestamp")
    )


def iso_text(time: Column) -> Column:
    """TIMESTAMP to ISO-8601 text in UTC, with microseconds."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def best_effort_time(text: Column) -> Column:
    """Time text, or the epoch when it cannot be read; never null."""
    return F.coalesce(iso_timestamp(text), F.timestamp_seconds(F.lit(0)))


def settled(*columns) -> Column:
    """Columns as the output of a generator of one row.

    The optimizer moves filters on a projection's output into its input, with the expressions copied
    into the filter. For a parser that means parsing twice; it does not happen across a generator.
    """
    return F.inline(F.array(F.struct(*columns)))
