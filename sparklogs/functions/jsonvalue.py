"""Reading JSON text of unknown shape through VARIANT members.

Spark's JSON readers stop at the end of the first value and so accept trailing text. The text is
therefore wrapped in an array together with an end mark: only when the whole text is one JSON object
does the array have exactly two elements with the mark in the second. One pass reads all the members
asked for; each is a VARIANT, so its JSON type is not lost.
"""

from pyspark.sql import Column, functions as F

_END = "<end of text>"
_OPTIONS = {"allowSingleQuotes": "false"}
WHITESPACE = " \t\r\n"


def _slot(name: str) -> str:
    """Column name for a JSON key: keys may differ in case alone, column names may not."""
    return "".join(f"^{c}" if c.isupper() else c for c in name)


def members(text: Column, names: list[str]) -> Column:
    """ARRAY<STRUCT<names..>> of the wrapped text; pass it to `is_object` and `member`."""
    wrapped = F.concat(F.lit("["), text, F.lit(f',{{"{_END}":1}}]'))
    fields = ", ".join(f"`{name}`: VARIANT" for name in names)
    slots = ", ".join(f"`{_slot(name)}`: VARIANT" for name in names)
    parsed = F.from_json(wrapped, f"ARRAY<STRUCT<{fields}, `{_END}`: INT>>", _OPTIONS)
    return parsed.cast(f"ARRAY<STRUCT<{slots}, `{_END}`: INT>>")


def is_object(parsed: Column) -> Column:
    """True when the text was exactly one JSON object."""
    first, second = F.get(parsed, 0), F.get(parsed, 1)
    whole = (F.size(parsed) == 2) & first.isNotNull() & first[_END].isNull() & (second[_END] == 1)
    return F.coalesce(whole, F.lit(False))


def member(parsed: Column, name: str) -> Column:
    """Member of the object, as VARIANT; null when absent."""
    return F.get(parsed, 0)[_slot(name)]


def is_json(text: Column) -> Column:
    """True when the whole text is one JSON value of any type."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))
    mark = F.try_variant_get(wrapped, "$[1]", "string")
    third = F.try_variant_get(wrapped, "$[2]", "variant")
    return F.coalesce((mark == _END) & third.isNull(), F.lit(False))


def text_of(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def kind(value: Column) -> Column:
    """Type name of a VARIANT: STRING, BIGINT, BOOLEAN, VOID, DECIMAL(..), DOUBLE, ARRAY<..>, OBJECT<..>."""
    return F.schema_of_variant(value)


def first_present(parsed: str, keys: list[str]) -> Column:
    """The first member of column `parsed` that is neither null nor the empty string, as VARIANT."""
    members = [f"get({parsed}, 0).`{_slot(key)}`" for key in keys]
    return F.expr("coalesce(" + ", ".join(
        f"CASE WHEN try_variant_get({m}, '$', 'string') <> '' THEN {m} END" for m in members) + ")")


def is_truthy(value: Column) -> Column:
    """False for absent, null, false, zero, and empty text, list or object."""
    text, type_name = text_of(value), kind(value)
    is_number = (type_name == "BIGINT") | (type_name == "DOUBLE") | type_name.startswith("DECIMAL")
    zero = is_number & (F.try_variant_get(value, "$", "double") == 0)
    return F.coalesce(
        ~text.isin("", "[]", "{}") & ~zero & ~((type_name == "BOOLEAN") & (text == "false")), F.lit(False)
    )


def first_truthy(parsed: Column, keys: list[str]) -> Column:
    return F.coalesce(*[F.when(is_truthy(member(parsed, key)), member(parsed, key)) for key in keys])


def whole_number(value: Column) -> Column:
    """Lenient integer: numbers are cut, digit text is read, booleans are 0 or 1, the rest is null.

    A number outside 64 bits becomes -1, which validation rejects for every field that uses this.
    """
    type_name, text = kind(value), text_of(value)
    number = F.try_variant_get(value, "$", "double")
    digits = F.regexp_replace(F.btrim(text), "_", "")
    out_of_range = F.lit(-1).cast("bigint")
    return (
        F.when(type_name == "BIGINT", F.try_variant_get(value, "$", "bigint"))
        .when(
            (type_name == "DOUBLE") | type_name.startswith("DECIMAL"),
            F.when(F.abs(number) < 9.2e18, number.try_cast("bigint")).otherwise(out_of_range),
        )
        .when(
            (type_name == "STRING") & F.btrim(text).rlike(r"^[+-]?\d+(?:_\d+)*$"),
            F.coalesce(digits.try_cast("bigint"), out_of_range),
        )
        .when(type_name == "BOOLEAN", F.when(text == "true", 1).otherwise(0).cast("bigint"))
    )


def real_number(value: Column) -> Column:
    """Lenient floating point number, null for anything that is not one."""
    type_name, text = kind(value), text_of(value)
    readable = F.btrim(text).rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$")
    return (
        F.when(
            (type_name == "BIGINT") | (type_name == "DOUBLE") | type_name.startswith("DECIMAL"),
            F.try_variant_get(value, "$", "double"),
        )
        .when((type_name == "STRING") & readable, F.btrim(text).try_cast("double"))
        .when(type_name == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
    )


def minify(text: Column) -> Column:
    """Drop whitespace between JSON tokens; keys keep their order."""
    return F.regexp_replace(text, r'("(?:[^"\\]|\\.)*+")|[ \t\r\n]+', "$1")
