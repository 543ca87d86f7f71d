"""Mixing sources to target weights with hash-threshold histograms; DataFrame functions only.

Sizes are summed by source and hash bucket; a running sum over a source's buckets finds the bucket
in which its budget ends. Only the rows of that bucket are summed again, by finer buckets, until
it holds one hash. Rows are then filtered by comparing their hash with their source's threshold:
nothing is sorted, and a larger budget's rows include a smaller one's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerscore.session import settle_groups, stage

#: Hex digits of a bucket on each level, and of the whole hash.
STEP, DIGITS = 3, 32


def n_words(text: str) -> Column:
    """Number of words, a null text's is 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float, most: float, weights: list[float]) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, take the weights in turn. Targets are in proportion to the
    weights and sum up to ``share`` of all sizes; none is above ``most`` times its source's size,
    and what a source can't take is shared by the others by weight. The windows are over sources,
    not over rows of documents.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    weight = F.element_at(F.array(*map(F.lit, weights)), turn.cast("int"))
    every = Window.partitionBy()
    # the sources that are capped are the first ones by size over weight
    rise = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source"
    )
    before = F.sum("source_size").over(rise.rowsBetween(Window.unboundedPreceding, -1))
    weights_left = F.sum("weight").over(rise.rowsBetween(0, Window.unboundedFollowing))
    left = F.lit(share) * F.sum("source_size").over(every) - F.lit(most) * F.coalesce(before, F.lit(0))
    cap = F.lit(most) * F.col("source_size")
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("level", left / weights_left).withColumn("place", F.row_number().over(rise))
    )
    uncapped = F.col("level") * F.col("weight") <= cap
    # the level of the first source that it doesn't cap holds for all
    level = F.min_by(F.when(uncapped, F.col("level")), F.when(uncapped, F.col("place"))).over(every)
    return ranked.withColumn("final", level).select(
        "source", "source_size",
        F.coalesce(F.least(F.col("final") * F.col("weight"), cap), cap).alias("target"),
    )


def _boundaries(rows: DataFrame, digits: int) -> DataFrame:
    """Per source, the bucket of so many hash digits in which its budget ends.

    ``rows`` has key, h, size, before (the sizes taken ahead of these rows) and rest (the budget).
    """
    by = Window.partitionBy("key").orderBy("prefix")
    histogram = (
        rows.groupBy("key", F.substring("h", 1, digits).alias("prefix"))
        .agg(
            F.sum("size").alias("inside"), F.count_if(F.col("size") > 0).alias("n"),
            F.first("before").alias("before"), F.first("rest").alias("rest"),
        )
    )
    up_to = F.col("before") + F.sum("inside").over(by)
    first = (
        histogram.withColumn("up_to", up_to).filter("up_to > rest")
        .groupBy("key").agg(F.min(F.struct("prefix", "up_to", "inside", "n", "rest")).alias("b"))
    )
    return first.select(
        "key", "b.prefix", (F.col("b.up_to") - F.col("b.inside")).alias("before"),
        "b.inside", "b.n", "b.rest",
    )


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(key, prefix, take): rows whose hash is below the prefix are in the budget; those at it too
    if ``take``. ``rows`` has key, h and size; ``budgets`` has key and rest.

    Sums of the taken sizes come as near to ``rest`` as the hash order allows.
    """
    start = budgets.select("key", "rest", F.lit(0).cast("long").alias("before"))
    found = stage(_boundaries(settle_join(rows, start), STEP), "boundary")
    for digits in range(2 * STEP, DIGITS + STEP, STEP):
        if not found.filter("n > 1").take(1):
            break
        # a bucket holds few rows, however many its source has
        state = found.select("key", "prefix", "rest", "before")
        inside = rows.withColumn("prefix", F.substring("h", 1, digits - STEP)).join(
            state, ["key", "prefix"]
        )
        found = stage(_boundaries(inside.drop("prefix"), digits), "boundary")
    half = 2 * (F.col("rest") - F.col("before")) >= F.col("inside")
    return found.select("key", "prefix", half.alias("take"))


def settle_join(rows: DataFrame, by_key: DataFrame, onto: DataFrame | None = None) -> DataFrame:
    """Join rows, or others with the same keys, to a table with one row per key; a hot key's rows
    stay where they are, and all of them do where the table is small."""
    counts = rows.groupBy("key").agg(F.count("*").alias("key_rows"))
    groups, _ = settle_groups(by_key.join(counts, "key"), ["key"], "key_rows")
    return groups.join(rows if onto is None else onto).drop("key_rows")


def _key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def _digest(id_col: str, text: str) -> Column:
    return F.md5(F.concat_ws(
        " ", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    ))


def _shares(
    docs: DataFrame, id_col: str, text: str, source: str,
    share: float, most: float, weights: tuple[float, ...],
) -> tuple[DataFrame, DataFrame]:
    """All rows without their texts, and per source (key, source_size, target, whole, prefix, take)."""
    rows = stage(
        docs.select(
            F.col(id_col), F.col(source).alias("source"), _key(source).alias("key"),
            _digest(id_col, text).alias("h"), n_words(text).alias("size"),
        ), "sizes",
    )
    sizes = rows.groupBy("key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size")
    )
    shares = stage(
        targets(sizes.select("source", "source_size"), share, most, list(weights))
        .withColumn("key", _key("source"))
        .withColumn("whole", F.coalesce(
            F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)
        ))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")),
        "targets",
    )
    ends = thresholds(rows, shares.select("key", "rest"))
    return rows, shares.drop("source", "rest").join(ends, "key", "left")


def _copies(digest: Column) -> Column:
    head = F.substring(digest, 1, F.length("prefix"))
    below = (head < F.col("prefix")) | ((head == F.col("prefix")) & F.col("take"))
    return F.col("whole") + F.coalesce(below, F.lit(False)).cast("long")


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = (3.0, 1.0, 2.0),
) -> DataFrame:
    """(id, hash, source, size, source_size, target, copies) of every row.

    ``copies`` is how often the mix takes the row: as many whole times as the target of its source
    holds the source, and once more if the row's hash is below the threshold of what is left. So
    the copies of a row differ by one at most within a source, none is above ``most`` rounded up,
    and the taken words of a source are within half the size of one row of its target.

    * Null or wordless text: size 0. Null source: a source of its own, the last one.
    * The hash is of id and text: reruns agree, and the order of rows has no part. Rows equal in
      both are taken together. Null ids are ids like others.
    * A source of size 0 has target 0. An empty table gives an empty table.
    """
    rows, shares = _shares(docs, id_col, text, source, share, most, weights)
    return settle_join(rows, shares).select(
        id_col, F.col("h").alias("hash"), "source", "size", "source_size", "target",
        _copies(F.col("h")).alias("copies"),
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = (3.0, 1.0, 2.0),
) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``docs``.

    Rows without words have no part in any budget and stay once. See ``mixed``. The hash, the size
    and the source are on the row, so rows are filtered and repeated where they are: the sources'
    thresholds travel to them, not the texts.
    """
    rows, shares = _shares(docs, id_col, text, source, share, most, weights)
    whole = docs.select(F.struct(*docs.columns).alias("row"), _key(source).alias("key"), *(
        made.alias(name) for name, made in (("h", _digest(id_col, text)), ("size", n_words(text)))
    ))
    known = settle_join(rows, shares, onto=whole)
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(_copies(F.col("h"))).cast("int")
    return (
        known.withColumn("times", times).filter("times > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
    )
