"""Files of log lines, JSON logs, request bodies and page edits, as batches or streams."""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import jsonvalue as J
from ..functions.text import SPACES
from ..operators.lookup import bounded, stored
from ..schemas import CHANGE_SCHEMA
from . import folders


# Everything Python calls the end of a line.
_LINE_END = r"\r\n|[\n\r\x0b\f\x1c-\x1e\x85\u2028\u2029]"
_BOM = "^\ufeff"


def _reader(spark: SparkSession, stream: bool, **options):
    reader = spark.readStream if stream else spark.read
    return reader.options(**options) if options else reader


def _not_blank(column: str) -> Column:
    return F.length(F.btrim(F.col(column), F.lit(SPACES))) > 0


def read_log_lines(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """Text lines in Latin-1: every byte is a character, so no byte can stop the read. Blank lines go."""
    lines = _reader(spark, stream, **options).format("text").load(path)
    decoded = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    return lines.select(decoded.alias("value")).filter(_not_blank("value"))


def read_ndjson(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """One JSON log per line, as text; a byte-order mark and blank lines go."""
    lines = _reader(spark, stream, **options).format("text").load(path)
    return lines.select(F.regexp_replace("value", _BOM, "").alias("value")).filter(_not_blank("value"))


def _whole(spark: SparkSession, path: str, largest: int | None) -> DataFrame:
    """(body, text) of each file, without a byte-order mark."""
    files = spark.read.format("text").option("wholetext", True).load(path)
    if largest is not None:
        files = files.filter(F.col("_metadata.file_size") <= largest)
    return files.select(F.col("_metadata.file_path").alias("body"), F.regexp_replace("value", _BOM, "").alias("text"))


def _is_array(text: str) -> Column:
    return F.btrim(F.col(text), F.lit(SPACES)).startswith("[")


def read_bodies(spark: SparkSession, path: str, largest: int | None = None) -> DataFrame:
    """One row per non-blank line of each file that is one request body: (body, line, value).

    With `largest`, files above that size are left out before they are opened; `oversized_bodies` lists them.
    """
    bodies = _whole(spark, path, largest)
    split = F.filter(F.split("text", _LINE_END), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    numbered = bodies.filter(~_is_array("text")).select("body", F.posexplode(split))
    return numbered.select("body", (F.col("pos") + 1).alias("line"), F.col("col").alias("value"))


def oversized_bodies(spark: SparkSession, path: str, largest: int) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    return files.filter(F.col("length") > largest)


def read_json_array(spark: SparkSession, path: str, largest: int | None = None) -> DataFrame:
    """Elements of files that are each one JSON array: (body, line, value), numbered from 1.

    A file that starts like an array but is none gives one row, its whole text, for intake to reject.
    """
    bodies = _whole(spark, path, largest)
    return json_array_items(bodies.filter(_is_array("text")), "text").select("body", "line", "value")


def json_array_items(frame: DataFrame, text: str) -> DataFrame:
    """One row per element of the JSON array in column `text`: its number from 1 and its JSON text.

    Text that is not JSON is one row as it is; an empty array has none.
    """
    kept = [c for c in frame.columns if c != text]
    bare = F.btrim(F.col(text), F.lit(SPACES))
    items = F.when(J.is_json(bare), F.try_parse_json(bare))
    parsed = frame.select(*kept, items.alias("_items"), F.when(items.isNull(), F.col(text)).alias("_broken"))
    elements = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode_outer(F.col("_items").outer()))
    elements = elements.filter(F.col("value").isNotNull() | F.col("_broken").isNotNull())
    return elements.select(*kept, F.coalesce(F.col("pos") + 1, F.lit(1)).alias("line"),
                           F.coalesce("_broken", F.to_json("value")).alias("value"))


def _pieces(spark: SparkSession, path: str, separator: str | None, largest: int | None) -> DataFrame:
    """(body, start, at, value): the pieces of files between separators, from as many tasks as the files have splits.

    `start` is where the split begins in the file, `at` grows with the place in the split; both order the pieces of a body.
    """
    reader = spark.read.format("text")
    pieces = (reader.option("lineSep", separator) if separator else reader).load(path)
    if largest is not None:
        pieces = pieces.filter(F.col("_metadata.file_size") <= largest)
    return pieces.select(F.col("_metadata.file_path").alias("body"), F.col("_metadata.file_block_start").alias("start"),
                         F.monotonically_increasing_id().alias("at"), "value")


def _inside(*order: str) -> Window:
    """The pieces of a split, up to and with the row."""
    return Window.partitionBy("body", "start").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(total: str) -> Column:
    """What the splits of a body before the row's come to. One row per split takes part, and no task holds more than a split."""
    earlier = Window.partitionBy("body").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(earlier), F.lit(0))


def _first_is_bracket(pieces: DataFrame) -> DataFrame:
    """body, is_array: whether the first thing in the file is `[`."""
    bare = F.btrim(F.regexp_replace("value", _BOM, ""), F.lit(SPACES))
    seen = pieces.select("body", "start", "at", bare.alias("bare")).filter("bare <> ''")
    return seen.groupBy("body").agg(F.min_by("bare", F.struct("start", "at")).startswith("[").alias("is_array"))


def read_large_bodies(spark: SparkSession, path: str, largest: int | None = None) -> DataFrame:
    """As `read_bodies`, for bodies of any size: lines come from all splits of a file, with their number in the body.

    A line must fit into a task, a body need not.
    """
    pieces = _pieces(spark, path, None, largest)
    clean = F.when(F.col("start") == 0, F.regexp_replace("value", _BOM, "")).otherwise(F.col("value"))
    lines = pieces.select("body", "start", "at", F.posexplode(F.split(clean, _LINE_END)).alias("pos", "value")).filter(_not_blank("value"))
    # The bodies come to their lines, or a body would be one task's.
    kinds = bounded(_first_is_bracket(pieces).filter("not is_array").select("body"), "bodies")
    lines = lines.join(kinds, "body", "left_semi")
    splits = lines.groupBy("body", "start").agg(F.count("*").alias("n"))
    splits = bounded(splits.select("body", "start", _before("n").alias("earlier")), "splits")
    numbered = lines.withColumn("line", F.count("*").over(_inside("at", "pos"))).join(splits, ["body", "start"])
    return numbered.select("body", (F.col("line") + F.col("earlier")).alias("line"), "value")


def read_large_arrays(spark: SparkSession, path: str, largest: int | None = None) -> DataFrame:
    """Elements of files that are each one JSON array of any size: (body, line, value, broken), numbered from 1.

    Files are read in pieces between commas, from all their splits. Quotes before a piece say whether it starts within a
    text, brackets outside texts how deep it is, both as running sums within splits and over splits; a piece that starts at the depth of the array, outside a text, starts an
    element, and the pieces of an element are put together again. An element must fit into a task, a body need not.
    `broken` marks all elements of a body whose brackets or quotes do not come out even; whether an element is JSON is for
    intake to say.
    """
    pieces = _pieces(spark, path, ",", largest)
    kinds = bounded(_first_is_bracket(pieces).filter("is_array").select("body"), "bodies")
    pieces = pieces.join(kinds, "body", "left_semi")
    clean = F.when(F.col("start") == 0, F.regexp_replace("value", _BOM, "")).otherwise(F.col("value"))
    parts = F.split(F.regexp_replace(clean, r"\\.", ""), '"', -1)

    def depth_change(parity: int) -> Column:
        """Brackets in every other part: outside texts, if the piece starts outside (0) or within (1) one."""
        outside = F.filter(F.col("_parts"), lambda x, i: i % 2 == parity)

        def count(signs: str) -> Column:
            return F.aggregate(outside, F.lit(0), lambda a, x: a + F.length(x) - F.length(F.translate(x, signs, "")))

        return count("[{") - count("]}")

    rows = pieces.select("body", "start", "at", clean.alias("value"), parts.alias("_parts"))
    rows = rows.select("body", "start", "at", "value", (F.size("_parts") - 1).alias("quotes"), depth_change(0).alias("out"), depth_change(1).alias("in"))
    # Whether a split starts within a text is known only when all earlier ones are summed up, so both cases are carried: step0 and depth0 if it does not.
    within = (F.sum("quotes").over(_inside("at")) - F.col("quotes")) % 2 == 1
    rows = rows.withColumn("within0", within).select(
        "body", "start", "at", "value", "quotes", "within0", F.when(F.col("within0"), F.col("in")).otherwise(F.col("out")).alias("step0"),
        F.when(F.col("within0"), F.col("out")).otherwise(F.col("in")).alias("step1"))
    rows = stored(rows.select("*", *[F.sum(f"step{i}").over(_inside("at")).alias(f"depth{i}") for i in (0, 1)]), "pieces")
    splits = rows.groupBy("body", "start").agg(F.sum("quotes").alias("quotes"), F.sum("step0").alias("sum0"), F.sum("step1").alias("sum1"))
    splits = splits.withColumn("cut", _before("quotes") % 2 == 1).withColumn("steps", F.when(F.col("cut"), F.col("sum1")).otherwise(F.col("sum0")))
    splits = bounded(splits.select("body", "start", "cut", _before("steps").alias("deep")), "splits")
    step, depth = (F.when(F.col("cut"), F.col(f"{n}1")).otherwise(F.col(f"{n}0")) for n in ("step", "depth"))
    rows = rows.join(splits, ["body", "start"]).select(
        "body", "start", "at", "value", "quotes", (F.col("within0") != F.col("cut")).alias("within"), step.alias("step"), (F.col("deep") + depth).alias("depth"))
    before = F.col("depth") - F.col("step")
    starts = ~F.col("within") & (before <= 1)  # the first piece is at depth 0, later elements at depth 1
    rows = rows.withColumn("starts", F.when(starts, 1).otherwise(0))
    # Depth 0 after a piece is the end of the array: nothing may follow it.
    sums = stored(rows.groupBy("body", "start").agg(
        F.sum("step").alias("step"), F.sum("quotes").alias("quotes"), F.count_if(F.col("depth") <= 0).alias("ends"), F.sum("starts").alias("starts")), "sums")
    whole = sums.groupBy("body").agg(
        (F.sum("step") != 0).alias("open"), (F.sum("quotes") % 2 != 0).alias("quoted"), F.sum("ends").alias("ends"), F.sum("starts").alias("last"))
    whole = bounded(whole.select("body", "last", (F.col("open") | F.col("quoted") | (F.col("ends") != 1)).alias("broken")), "bodies")
    earlier = bounded(sums.select("body", "start", _before("starts").alias("earlier")), "splits")
    rows = rows.withColumn("line", F.sum("starts").over(_inside("at"))).join(earlier, ["body", "start"])
    rows = rows.withColumn("line", F.col("line") + F.col("earlier"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "at", "value"))), lambda p: p["value"]), ",")
    items = rows.groupBy("body", "line").agg(joined.alias("value")).join(whole, "body")
    bare = F.btrim("value", F.lit(SPACES))
    opened = F.when(F.col("line") == 1, F.regexp_replace(bare, r"^\[", "")).otherwise(bare)
    closed = F.when(F.col("line") == F.col("last"), F.regexp_replace(opened, r"\]$", "")).otherwise(opened)
    items = items.select("body", F.col("line").cast("int").alias("line"), F.btrim(closed, F.lit(SPACES)).alias("value"), "broken", "last")
    return items.filter((F.col("value") != "") | (F.col("last") > 1)).drop("last")


def rejected_bodies(spark: SparkSession, path: str, largest: int) -> DataFrame:
    """(body, reason) of the files that are refused before they are opened: empty_body or too_large.

    They are told from the listing: readers pass over empty files.
    """
    refused = [(name, "too_large" if size else "empty_body") for name, size in folders.sizes(spark, path).items() if not size or size > largest]
    return spark.createDataFrame(refused, "body string, reason string")


def read_changes(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """Page-edit documents, one JSON object per line."""
    return _reader(spark, stream, **options).format("json").schema(CHANGE_SCHEMA).load(path)


def read_stream_files(spark: SparkSession, path: str, schema, form: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Stream over a folder of files; the stand-in for a keyed topic where there is no broker."""
    options = {} if files_per_batch is None else {"maxFilesPerTrigger": str(files_per_batch)}
    return _reader(spark, True, **options).format(form).schema(schema).load(path)
