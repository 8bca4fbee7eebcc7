"""Personal data replaced by keyed surrogates of the same type.

Detected are mail addresses, phone numbers, IPv4 addresses, card-like and social security numbers, IBANs, secrets
(assigned tokens, long hexadecimal strings, well-known key forms) and names after a title. A value is reduced to its
canonical form (digits of a number, lower-case address, one word of a name), so all spellings of it share a
surrogate everywhere. The surrogate follows from a key: digits become digits (Luhn-valid numbers stay so, a
phone's country code stays), letters become letters of the same case and script, an address keeps its top
domain, names follow the title's gender and the word's script; each occurrence keeps its own punctuation.

Distinct values get distinct surrogates, and none equals a real value: all surrogates of the table are grouped
and compared with the values, and those in conflict are drawn again until there are none. Values and surrogates stay in
tables; nothing is collected.

Nulls and odd rows: null and empty texts stay as they are; equal texts are looked up once and changed alike;
values inside one another count as the outer one. An empty table gives an empty result. All columns are kept.
"""

from pyspark.sql import Column, DataFrame, functions as F

from .common import free, quoted, stored

KEY = "pii-1"  # a fixed default for repeatable tests; pass a secret one in production
MAX_DRAWS = 64

_MALE = "Mr|Herrn?|Monsieur|Señor|Sr|Don|г-н"
_FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Mademoiselle|Señora|Señorita|Sra|Doña|г-жа"
_ANY = "Dr|Prof"
_NAME_WORD = r"\p{Lu}\p{Ll}[\p{L}'-]*"
TITLE = rf"(?:{_FEMALE}|{_MALE}|{_ANY})\.? "
NAME = rf"\b{TITLE}{_NAME_WORD}(?: {_NAME_WORD})?"
# Each run of address characters is tried once, from its start, so a long word costs its length.
MAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"
SECRET_HEAD = r"""(?i:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key)["']?\s?[=:]\s?["']?"""
SECRET = rf"{SECRET_HEAD}[A-Za-z0-9+/_=.-]{{8,}}"
BARE_SECRET = r"\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9_-]{20,}|(?=[a-f]*[0-9])(?=[0-9]*[a-f])[a-f0-9]{32,})\b"
IBAN = r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b"
IPV4 = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7})(?![0-9])"
PHONE = (r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}"
         r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])")
# In the order they are tried at a place.
ANY = "|".join(["(?:" + p + ")" for p in (SECRET, MAIL, BARE_SECRET, IBAN, IPV4, SSN, CARD, PHONE, NAME)])
# Any text that fits none of these has no value; a scan for single characters is cheap.
MAYBE = rf"[0-9@=:]|{TITLE}\p{{Lu}}"

_LATIN_SYLLABLES = "ba be bi bo da de di do fa fe fi ga go ka ke ki la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi".split()
_CYRILLIC_SYLLABLES = [a + b for a in "бвдклмнрст" for b in "аеио"]
_GREEK_SYLLABLES = [a + b for a in "βδκλμνπρστ" for b in "αειο"]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def kind_of(value: Column) -> Column:
    whole = [("secret", SECRET), ("mail", MAIL), ("secret", BARE_SECRET), ("iban", IBAN), ("ip", IPV4), ("ssn", SSN),
             ("card", CARD), ("phone", PHONE)]
    kind = F.lit("name")
    for name, pattern in reversed(whole):
        kind = F.when(value.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def pieces(text: Column) -> tuple[Column, Column]:
    """The text as an array of (pre, kind, canon, shown), each a value and what stands before it, and the rest.

    A name gives one piece per word, its title belongs to what stands before.
    """
    found, between = F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), F.split(text, ANY, -1)

    def unit(pre: Column, kind: Column, canon: Column, shown: Column) -> Column:
        return F.struct(pre.alias("pre"), kind.alias("kind"), canon.alias("canon"), shown.alias("shown"))

    def split_name(pre: Column, value: Column) -> Column:
        title = F.regexp_extract(value, f"^{TITLE}", 0)
        names = F.split(F.substr(value, F.length(title) + 1), " ", -1)
        given, gender = F.element_at(names, 1), F.when(title.rlike(rf"^(?:{_FEMALE})\.? $"), "f").when(
            title.rlike(rf"^(?:{_MALE})\.? $"), "m").otherwise("x")
        script = F.when(given.rlike(r"\p{IsCyrillic}"), "cyr").when(given.rlike(r"\p{IsGreek}"), "grk").otherwise("lat")
        surname = F.concat(F.lit("surname-"), script)
        last = F.element_at(names, -1)
        one = F.array(unit(F.concat(pre, title), surname, F.lower(last), last))
        two = F.array(unit(F.concat(pre, title), F.concat(F.lit("given-"), gender, F.lit("-"), script), F.lower(given), given),
                      unit(F.lit(" "), surname, F.lower(last), last))
        return F.when(F.size(names) > 1, two).otherwise(one)

    def split_value(pre: Column, value: Column) -> Column:
        kind, digits = kind_of(value), _digits(value)
        head = F.regexp_extract(value, f"^{SECRET_HEAD}", 0)
        # A phone is its last ten digits, so it is one with and without its country code.
        canon = (F.when(kind == "secret", F.substr(value, F.length(head) + 1)).when(kind == "mail", F.lower(value))
                 .when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).when(kind == "ip", value)
                 .when(kind == "phone", F.right(digits, F.lit(10))).otherwise(digits))
        shown = F.when(kind == "secret", canon).otherwise(value)
        plain = F.array(unit(F.when(kind == "secret", F.concat(pre, head)).otherwise(pre), kind, canon, shown))
        return F.when(kind == "name", split_name(pre, value)).otherwise(plain)

    paired = F.arrays_zip(between.alias("pre"), found.alias("value"))
    paired = F.slice(paired, F.lit(1), F.size(found))
    return F.flatten(F.transform(paired, lambda p: split_value(p["pre"], p["value"]))), F.element_at(between, -1)


def _stream(key: str, kind: Column, canon: Column, draw: Column, n: Column) -> Column:
    """At least n numbers 0..255 that follow from the value, as an array."""
    seed = F.concat_ws("|", F.lit(key), kind, canon, draw.cast("string"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor(n / 32).cast("int")), lambda i: F.sha2(
        F.concat(seed, F.lit("|"), i.cast("string")), 256))
    pairs = F.regexp_extract_all(F.array_join(blocks, ""), F.lit("[0-9a-f]{2}"), F.lit(0))
    return F.transform(pairs, lambda p: F.conv(p, 16, 10).cast("int"))


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _like(text: Column, numbers: Column, only_hex: Column) -> Column:
    """The text with every letter and digit replaced by one of its class; other characters stay."""
    def pick(letters: str, number: Column) -> Column:
        return F.substring(F.lit(letters), number % len(letters) + 1, F.lit(1))

    def one(c: Column, number: Column) -> Column:
        plain = (F.when(c.rlike("[0-9]"), pick(_CLASSES[0], number)).when(c.rlike("[a-z]"), F.when(only_hex, pick("abcdef", number))
                 .otherwise(pick(_CLASSES[1], number))).when(c.rlike("[A-Z]"), pick(_CLASSES[2], number)))
        other = (F.when(c.rlike(r"\p{IsCyrillic}"), pick("абвгдеиклмнопрст", number))
                 .when(c.rlike(r"\p{L}"), pick(_CLASSES[1], number)).when(c.rlike(r"\p{N}"), pick(_CLASSES[0], number)).otherwise(c))
        return F.coalesce(plain, other)

    characters = F.filter(F.split(text, "", -1), lambda c: c != "")
    return F.array_join(F.zip_with(characters, F.slice(numbers, F.lit(1), F.size(characters)), one), "")


def _luhn(digits: Column) -> Column:
    """The digits with the last one set so that the check sum holds."""
    body = F.reverse(F.filter(F.split(F.substr(digits, F.lit(1), F.length(digits) - 1), "", -1), lambda c: c != ""))
    doubled = F.transform(body, lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))
                          .otherwise(c.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    return F.concat(F.substr(digits, F.lit(1), F.length(digits) - 1), ((10 - total % 10) % 10).cast("string"))


def surrogate(key: str, kind: Column, canon: Column, draw: Column) -> Column:
    numbers = _stream(key, kind, canon, draw, F.length(canon) + 8)
    only_hex = canon.rlike("^[0-9a-f]+$")
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    top = F.substring_index(domain, ".", -1)
    inner = F.substr(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    # The domain follows from itself alone: colleagues stay colleagues.
    mail = F.concat(_like(local, numbers, F.lit(False)), F.lit("@"),
                    _like(inner, _stream(key, F.lit("domain"), domain, F.lit(0), F.length(domain)), F.lit(False)), F.lit("."), top)
    octets = F.split(canon, r"\.")
    private = canon.rlike(r"^(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\.")
    ip = F.concat_ws(".", F.when(private, octets[0]).otherwise((numbers[0] % 223 + 1).cast("string")),
                     F.when(private & ~canon.startswith("10."), octets[1]).otherwise(numbers[1].cast("string")),
                     numbers[2].cast("string"), numbers[3].cast("string"))
    digits = _like(canon, numbers, F.lit(False))
    card = F.when((F.length(canon) > 1) & (_luhn(canon) == canon), _luhn(digits)).otherwise(digits)

    def name(syllables: list[str], ends: dict[str, str]) -> Column:
        table = F.array(*[F.lit(s) for s in syllables])
        count = 2 + F.floor(draw / 8).cast("int")
        stem = F.array_join(F.transform(F.slice(numbers, F.lit(1), count), lambda i: table[i % len(syllables)]), "")
        ending = F.lit("")
        for start, end in ends.items():
            ending = F.when(kind.startswith(start), end).otherwise(ending)
        return F.initcap(F.concat(stem, ending))

    person = (F.when(kind.endswith("cyr"), name(_CYRILLIC_SYLLABLES, {"given-f": "на", "given-m": "н", "surname": "нко"}))
              .when(kind.endswith("grk"), name(_GREEK_SYLLABLES, {"given-f": "να", "given-m": "ς", "surname": "δης"}))
              .otherwise(name(_LATIN_SYLLABLES, {"given-f": "na", "given-m": "n", "surname": "rd"})))
    iban = F.concat(F.left(canon, F.lit(2)), _like(F.substr(canon, F.lit(3)), numbers, F.lit(False)))
    return (F.when(kind == "mail", mail).when(kind == "ip", ip).when(kind == "card", card).when(kind == "iban", iban)
            .when(kind == "secret", _like(canon, numbers, only_hex)).when(kind.isin("phone", "ssn"), digits).otherwise(person))


def assign(values: DataFrame, key: str = KEY) -> DataFrame:
    """kind, canon, surrogate: distinct for distinct values of a kind and equal to no value of that kind.

    Conflicts are found by grouping the surrogates of the whole table; of each group the value that comes
    first in text order keeps it. Only the others are drawn again.
    """
    values = stored(values.select("kind", "canon").distinct(), "pii-values")
    fixed, pending = None, values.withColumn("draw", F.lit(0))
    for _ in range(MAX_DRAWS):
        drawn = pending.withColumn("surrogate", surrogate(key, F.col("kind"), F.col("canon"), F.col("draw")))
        drawn = stored(drawn, "pii-drawn")
        everything = drawn.select("kind", "canon", "surrogate", F.lit(1).alias("new"))
        if fixed is not None:
            everything = everything.unionByName(fixed.select("kind", "canon", "surrogate", F.lit(0).alias("new")))
        owners = everything.groupBy("kind", "surrogate").agg(
            F.count("*").alias("n"), F.min(F.struct("new", "canon")).alias("owner"))
        real = values.select("kind", F.col("canon").alias("surrogate"), F.lit(True).alias("real"))
        taken = owners.join(real, ["kind", "surrogate"], "left").filter((F.col("n") > 1) | F.col("real"))
        marks = drawn.join(taken, ["kind", "surrogate"], "left")
        clash = F.coalesce(F.col("real") | (F.col("owner.canon") != F.col("canon")) | (F.col("owner.new") == 0), F.lit(False))
        marks = stored(marks.select("kind", "canon", "draw", "surrogate", clash.alias("clash")), "pii-marks")
        good = marks.filter(~F.col("clash")).select("kind", "canon", "surrogate")
        fixed = good if fixed is None else stored(fixed.unionByName(good), "pii-fixed")
        if marks.filter("clash").isEmpty():
            return fixed
        pending = marks.filter("clash").select("kind", "canon", (F.col("draw") + 1).alias("draw"))
    raise ValueError("more values of a kind than it has surrogates")


def render(kind: Column, shown: Column, value: Column) -> Column:
    """The surrogate in the spelling of the occurrence."""
    gaps = F.split(shown, "[0-9]", -1)
    digits = F.filter(F.split(value, "", -1), lambda c: c != "")
    # Digits before the canonical ones (a country code) stay.
    own = F.filter(F.split(_digits(shown), "", -1), lambda c: c != "")
    filled = F.concat(F.slice(own, F.lit(1), F.greatest(F.size(own) - F.size(digits), F.lit(0))), digits)
    number = F.array_join(F.zip_with(gaps, filled, lambda g, d: F.concat(F.coalesce(g, F.lit("")), F.coalesce(d, F.lit("")))), "")
    spaced = F.when(shown.contains(" "), F.rtrim(F.regexp_replace(value, "(.{4})", "$1 "))).otherwise(value)
    return F.when(kind.isin("phone", "card", "ssn"), number).when(kind == "iban", spaced).otherwise(
        F.when((F.upper(shown) == shown) & ~kind.isin("secret", "ip"), F.upper(value)).otherwise(value))


def pseudonymise(docs: DataFrame, key: str = KEY, count: str | None = None) -> DataFrame:
    """The documents with surrogates in `text`; `count` names a column for the number of replaced values.

    Texts that can hold no value pass in one scan. The others are joined to the list of their surrogates by
    the digest of the text, so equal texts, however many, are looked up once.
    """
    names = {n: free(docs, f"_pii_{n}") for n in ("key", "new", "own")}
    maybe = F.coalesce(F.col("text").rlike(MAYBE), F.lit(False))
    suspects = docs.filter(maybe).select(F.md5("text").alias("key"), "text").groupBy("key").agg(F.first("text").alias("text"))
    units = suspects.select("key", F.posexplode(pieces(F.col("text"))[0]).alias("at", "unit"))
    units = stored(units.select("key", "at", "unit.kind", "unit.canon", "unit.shown"), "pii-units")
    surrogates = assign(units, key)
    shown = units.join(surrogates, ["kind", "canon"]).select("key", "at", render(
        F.col("kind"), F.col("shown"), F.col("surrogate")).alias("new"))
    listed = shown.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "new"))).alias("list"))
    listed = stored(listed.select(F.col("key").alias(names["key"]), F.col("list.new").alias(names["new"])), "pii-lists")
    columns = [c for c in docs.columns if c != count]
    joined = docs.filter(maybe).withColumn(names["own"], F.md5("text")).join(
        listed, F.col(names["own"]) == F.col(names["key"]), "left")
    found, rest = pieces(F.col("text"))
    new = F.col(names["new"])
    text = F.when(new.isNull(), F.col("text")).otherwise(F.concat(F.array_join(F.zip_with(
        found, new, lambda p, v: F.concat(p["pre"], v)), ""), rest))

    def out(frame: DataFrame, text: Column, number: Column | None) -> DataFrame:
        return frame.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in columns],
                            *([number.alias(count)] if count else []))

    number = F.when(new.isNull(), F.lit(0)).otherwise(F.size(new)).cast("bigint")
    return out(docs.filter(~maybe), F.col("text"), F.lit(0).cast("bigint")).unionByName(out(joined, text, number))
