"""One large JSON array, read by many tasks.

Text that is split anywhere does not tell whether it begins inside a string, or how deep. So a
range of the file is first described for every state it might begin in: whether its quotes flip
"inside a string", and how many brackets it opens, less those it closes, if it begins outside of a
string and if it begins inside. These few descriptions are composed in file order, which gives the
state that each range really begins in. Then every range cuts and parses its own records; only the
one record that is torn at each edge of a range is put together from its pieces.

The text source cuts the file after every ``}``, a byte that no longer UTF-8 character contains, so
ranges never begin within a character, nor after a backslash that still waits for its character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from peerscore.schemas import BRONZE, CORRUPT
from peerscore.session import is_small, settle

#: Fragments per range at most; a range also ends where a split of the file does.
RANGE = 1 << 16

_FILE = ["_file"]
_OF_RANGE = ["_file", "_block", "_part"]
# What comes before the first record, before the others, and after the last one.
_FIRST, _NEXT = r"^\s*\[\s*", r"^\s*,\s*"
_END, _EMPTY = r"^\s*\]\s*$", r"^\s*\[\s*\]\s*$"


def _count(text: Column, letters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, letters, ""))


def _opened(text: Column) -> Column:
    """Brackets opened, less those closed, outside of strings."""
    outside = F.regexp_replace(text, '"[^"]*("|$)', "")
    return _count(outside, "{[") - _count(outside, "]")


def fragments(spark: SparkSession, path: str, per_range: int = RANGE) -> DataFrame:
    """The file's text up to each ``}``, with its range, its place, and what it does to either state."""
    text = (
        spark.read.option("lineSep", "}").text(path)
        .select(
            "value", F.monotonically_increasing_id().alias("_seq"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.col("_metadata.file_size").alias("_file_size"),
        )
    )
    # A character after a backslash never ends a string and opens nothing.
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    nth = F.col("_seq").bitwiseAND(F.lit((1 << 33) - 1))
    return text.select(
        "*", F.floor(nth / per_range).alias("_part"),
        (_count(plain, '"') % 2).cast("int").alias("_flips"),
        _opened(plain).alias("_if_outside"),
        _opened(F.concat(F.lit('"'), plain)).alias("_if_inside"),
    )


def _in_ranges(rows: DataFrame) -> DataFrame:
    """The rows with the change of depth at each fragment if the range begins outside a string
    (``_d0``) or inside one (``_d1``), and whether its own ``}`` is then inside one (``_s0``, ``_s1``)."""
    order = W.partitionBy(*_OF_RANGE).orderBy("_seq")
    before = F.coalesce(F.sum("_flips").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    seen = rows.withColumn("_before", before)
    for start in (0, 1):
        inside = (F.col("_before") + start) % 2 == 1
        closes_inside = (F.col("_before") + F.col("_flips") + start) % 2 == 1
        opened = F.when(inside, F.col("_if_inside")).otherwise(F.col("_if_outside"))
        seen = seen.withColumns({
            f"_s{start}": closes_inside, f"_d{start}": opened - F.when(closes_inside, 0).otherwise(1),
        })
    return seen


def ranges(rows: DataFrame) -> DataFrame:
    """One row per range with the state that it begins in: ``_inside`` a string, and ``_depth``.

    ``_cut`` is the last fragment of a file that does not end with ``}``, which so was never there.
    ``_unclosed`` marks the last range of a file whose array does not end.
    """
    described = _in_ranges(rows).groupBy(*_OF_RANGE).agg(
        (F.sum("_flips") % 2).alias("_odd"),
        F.sum("_d0").alias("_opens0"), F.sum("_d1").alias("_opens1"),
        F.max_by("_s0", "_seq").alias("_last0"),
        F.max("_seq").alias("_last_seq"),
        F.sum(F.octet_length("value") + 1).alias("_bytes"),
        F.max("_file_size").alias("_size"),
    )
    order = W.partitionBy(*_FILE).orderBy("_block", "_part")
    before, whole = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(*_FILE)
    inside = F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2 == 1
    begun = described.withColumn("_inside", inside).withColumn(
        "_opens", F.when(F.col("_inside"), F.col("_opens1")).otherwise(F.col("_opens0"))
    )
    is_last = F.lead("_block").over(order).isNull()
    open_end = F.sum("_bytes").over(whole) != F.col("_size")
    placed = begun.select(
        *_OF_RANGE, "_inside",
        F.coalesce(F.sum("_opens").over(before), F.lit(0)).alias("_depth"),
        F.when(is_last & open_end, F.col("_last_seq")).alias("_cut"),
        is_last.alias("_is_last"), "_opens",
        (F.col("_inside") != F.col("_last0")).alias("_ends_inside"),
        F.row_number().over(order).alias("_nth"),
    )
    added = F.when(F.col("_cut").isNotNull() & ~F.col("_ends_inside"), 1).otherwise(0)
    closed = (F.col("_depth") + F.col("_opens") + added == 0) & ~F.col("_ends_inside")
    return placed.withColumn("_unclosed", F.col("_is_last") & ~closed).drop("_opens", "_ends_inside")


def _pieces(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """Per range and record, the text that the range holds of it; ``_ends`` where the record ends."""
    at = F.when(F.col("_inside"), F.col("_d1")).otherwise(F.col("_d0"))
    in_string = F.when(F.col("_inside"), F.col("_s1")).otherwise(F.col("_s0"))
    order = W.partitionBy(*_OF_RANGE).orderBy("_seq")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    real = F.coalesce(F.col("_seq") != F.col("_cut"), F.lit(True))
    known = (
        _in_ranges(rows).join(starts, _OF_RANGE)
        .withColumn("_end", (F.col("_depth") + F.sum(at).over(upto) == 1) & ~in_string & real)
        .withColumn("_local", F.coalesce(
            F.sum(F.col("_end").cast("int")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ))
        .withColumn("_text", F.concat("value", F.when(real, "}").otherwise("")))
    )
    parts = F.array_sort(F.collect_list(F.struct("_seq", "_text")))
    return known.groupBy(*_OF_RANGE, "_local").agg(
        F.array_join(parts["_text"], "").alias("_text"), F.max("_end").alias("_ends"),
        F.first("_nth").alias("_nth"),
    )


def _whole(pieces: DataFrame) -> DataFrame:
    """(_text, _first, _ends) per record; those torn at an edge of ranges are put together."""
    torn = (F.col("_local") == 0) | ~F.col("_ends")
    own = pieces.filter(~torn).select("_text", F.lit(False).alias("_first"), "_ends")
    # At most two pieces per range: the end of a record, and the beginning of the next one.
    edges, _ = settle(pieces.filter(torn).drop("_block", "_part"))
    order = W.partitionBy(*_FILE).orderBy("_nth", "_local")
    number = F.coalesce(
        F.sum(F.col("_ends").cast("int")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    parts = F.array_sort(F.collect_list(F.struct("_nth", "_local", "_text")))
    joined = edges.withColumn("_number", number).groupBy(*_FILE, "_number").agg(
        F.array_join(parts["_text"], "").alias("_text"),
        (F.col("_number") == 0).alias("_first"), F.max("_ends").alias("_ends"),
    )
    return own.unionByName(joined.select("_text", "_first", "_ends"))


def read_arrays(spark: SparkSession, path: str, per_range: int = RANGE) -> DataFrame:
    """Raw places from files of one top-level array of objects each, however large, in UTF-8.

    The rows are those of ``read_bronze(multi_line=True)``, but a file is read by as many tasks as
    it has splits, and cut into records by as many as it has ranges. Text that is no object, or not
    parted by a comma, and an array that does not end each give a row with a corrupt record. The
    file is read twice: its brackets and quotes first, which move as a few numbers per fragment,
    then its text, which moves once.
    """
    schema = StructType([*BRONZE.fields, StructField(CORRUPT, StringType())])
    rows = fragments(spark, path, per_range)
    starts, seen = settle(ranges(rows))
    records = _whole(_pieces(rows, F.broadcast(starts) if is_small(seen) else starts))

    before = F.when(F.col("_first"), F.regexp_extract("_text", _FIRST, 0)).otherwise(
        F.regexp_extract("_text", _NEXT, 0)
    )
    bare = F.substr("_text", F.char_length(before) + 1)
    fits = F.col("_ends") & (before != "") & bare.startswith("{")
    nothing = F.when(F.col("_first"), F.col("_text").rlike(_EMPTY)).otherwise(F.col("_text").rlike(_END))
    options = {"columnNameOfCorruptRecord": CORRUPT}
    parsed = (
        records.filter(F.col("_ends") | ~nothing)
        .select(F.when(fits, bare).alias("_bare"), "_text")
        .select("_bare", "_text", F.from_json("_bare", schema, options).alias("_place"))
    )
    whole = parsed.select(
        *(F.col(f"_place.{name}").alias(name) for name in BRONZE.names),
        F.when(F.col("_bare").isNull(), F.col("_text")).otherwise(F.col(f"_place.{CORRUPT}")).alias(CORRUPT),
    )
    unclosed = starts.filter("_unclosed").select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in BRONZE),
        F.concat(F.lit("no end of the array: "), F.col("_file")).alias(CORRUPT),
    )
    return whole.unionByName(unclosed)
