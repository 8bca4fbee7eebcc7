"""Chat formatting with typed content parts, a reversible template and a loss mask.

A turn's content is an array of parts (text, image, audio, document). `flatten_parts` visits them in order:
texts are escaped, every other part becomes a placeholder, and its reference and the tokens it will expand to
are recorded. `format_conversations` joins the turns of a conversation under the template and notes the byte
ranges of what is trained on; `read_back` parses the output again.

Template: `<|im_start|>role\\ntext<|im_end|>\\n`. Within role and text `\\` is written `\\\\` and `<|` is
written `<\\|`, in a role a line feed is written `\\n`: no control string can occur inside, and reading undoes it.

Nulls and odd rows: null text and null role are empty; a null conversation id is a conversation of its own;
null turns come first; turns with the same number are ordered by role, then text, and repeated rows are all
kept. Null parts and parts of unknown kind without text are empty; null sizes count 0 tokens. An empty table
gives an empty result. Further columns are ignored. A conversation ends up in one row, as its format asks,
so its length is bounded by Spark's 2 GB per value.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import present

TURN, END = "<|im_start|>", "<|im_end|>\n"
PART = "kind string, text string, ref string, width int, height int, seconds double, pages int"
PARTS = "array<struct<" + ",".join(p.replace(" ", ":") for p in PART.split(", ")) + ">>"
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25, 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Undo both. Between doubled backslashes only single escapes are left."""
    pieces = F.transform(F.split(text, r"\\\\", -1), lambda p: F.replace(
        F.replace(p, F.lit("\\|"), F.lit("|")), F.lit("\\n"), F.lit("\n")))
    return F.array_join(pieces, "\\")


def part_tokens(part: Column) -> Column:
    """Tokens a part takes once its placeholder is expanded."""
    patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    counts = (F.when(part["kind"] == "image", patches).when(part["kind"] == "audio", F.ceil(part["seconds"] * AUDIO_RATE))
              .when(part["kind"] == "document", part["pages"] * PAGE_TOKENS))
    return F.coalesce(counts, F.lit(0)).cast("bigint")


def flatten_parts(parts: Column) -> tuple[Column, Column]:
    """The escaped text with placeholders, and the attachments (slot, kind, ref, tokens) in their order."""
    def attached(part: Column) -> Column:
        return F.coalesce(part["kind"].isin("image", "audio", "document"), F.lit(False))

    text = F.array_join(F.transform(parts, lambda p: F.when(attached(p), F.concat(F.lit("<|"), p["kind"], F.lit("|>")))
                                    .otherwise(escape(F.coalesce(p["text"], F.lit(""))))), "")
    slots = F.transform(F.filter(parts, attached), lambda p, i: F.struct(
        i.cast("int").alias("slot"), p["kind"].alias("kind"), p["ref"].alias("ref"), part_tokens(p).alias("tokens")))
    return text, slots


def text_part(text: Column) -> Column:
    nothing = {name: F.lit(None).cast(kind) for name, kind in (p.split() for p in PART.split(", "))}
    values = nothing | {"kind": F.lit("text"), "text": text}
    return F.array(F.struct(*[c.alias(n) for n, c in values.items()]))


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """conv_id, n_turns, formatted, mask (array of start, length in bytes of the UTF-8 output), attachments.

    `turns` has conv_id, turn, role and either `content` (array of parts, see PART) or `text`.
    """
    parts = F.col("content") if "content" in turns.columns else text_part(F.col("text"))
    text, slots = flatten_parts(F.coalesce(parts, F.array().cast(PARTS)))
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = turns.select("conv_id", present(turns, "turn", "bigint").alias("turn"), role.alias("role"),
                        text.alias("text"), slots.alias("slots"))
    head = F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n"))
    rows = rows.withColumn("head", head)
    length = (F.octet_length("head") + F.octet_length("text") + len(END)).cast("bigint")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = F.coalesce(F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.select("conv_id", F.row_number().over(order).alias("place"), before.alias("before"), "role", "head", "text", "slots")
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("place", "before", "role", "head", "text", "slots"))).alias("rows"))
    trained = F.filter("rows", lambda r: r["role"] == trained_role)
    return gathered.select(
        "conv_id", F.size("rows").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("rows", lambda r: F.concat(r["head"], r["text"], F.lit(END))), "").alias("formatted"),
        F.transform(trained, lambda r: F.struct((r["before"] + F.octet_length(r["head"])).alias("start"),
                                                F.octet_length(r["text"]).alias("length"))).alias("mask"),
        F.flatten(F.transform("rows", lambda r: r["slots"])).alias("attachments"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text), trained (all text under the mask), from the output alone."""
    pieces = F.split(F.col("formatted"), r"<\|im_end\|>\n", -1)
    bodies = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: F.substr(p, F.lit(len(TURN) + 1)))
    turns = F.transform(bodies, lambda b: F.struct(
        unescape(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(F.substr(b, F.instr(b, F.lit("\n")) + 1)).alias("text")))
    raw = F.col("formatted").cast("binary")
    masked = F.transform("mask", lambda m: unescape(F.substring(raw, (m["start"] + 1).cast("int"), m["length"]).cast("string")))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), F.array_join(masked, "").alias("trained"))


def digests(read: DataFrame) -> DataFrame:
    """The digest columns of what was read back."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("trained").cast("bigint").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
