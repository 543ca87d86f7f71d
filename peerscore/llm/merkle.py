"""A Merkle manifest of a dataset: one root digest, and a proof for any row, by descending a DAG.

Leaves are digests of rows. Within a group they are ranked by an order, and while several nodes
remain, every ``ARITY`` consecutive ones become their digest; the groups' last nodes are folded the
same way into the root. What is stored are records of a digest and its children, in segments of
``LEVELS`` levels, so a group of any size is folded by many tasks and a segment is a bounded row.

Requests for leaves descend from the root. The digits of a rank say which segment and which child
to enter; the children that are not entered are the proof. Requests that share a segment enter the
one above it once, so no segment is asked by more than its own leaves. The collected path runs from
the root to the leaf; reversed, it folds a leaf into a root again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from peerscore.llm.frames import schema_with
from peerscore.session import Groups, settle_groups, stage

#: Consecutive nodes that become one.
ARITY = 2
#: Levels per segment: a segment has at most ARITY ** LEVELS nodes at its foot.
LEVELS = 10

_RECORDS = "array<struct<digest:string,children:array<string>>>"


def digest_of(*fields: Column) -> Column:
    """The lowercase hex SHA-256 of fields, each ``-`` if null, else its UTF-8 length, ``:`` and
    its text, so that no two different rows are spelled alike."""
    texts = [f.cast("string") for f in fields]
    spelled = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts
    ]
    return F.sha2(F.concat(*spelled), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf has with a path from the root, as ``Manifest.proofs`` returns it."""
    return F.aggregate(
        F.reverse(path), leaf,
        lambda node, level: F.sha2(
            F.concat(F.split_part(level, F.lit(":"), F.lit(1)), node,
                     F.split_part(level, F.lit(":"), F.lit(2))), 256
        ),
    )


def siblings(path: Column) -> Column:
    """All siblings of a path, from the leaf's level up to the root's, left to right."""
    return F.translate(F.array_join(F.reverse(path), ""), ":", "")


def _fold(nodes: list[str], n: int, levels: int) -> tuple[str, list[tuple[str, list[str]]]]:
    """The digest of a segment's foot, and its records. ``n`` nodes are on that level in all."""
    records = []
    for _ in range(_height(n, levels)):
        above = []
        for i in range(0, len(nodes), ARITY):
            run = nodes[i : i + ARITY]
            above.append(sha256("".join(run).encode()).hexdigest())
            records.append((above[-1], run))
        nodes = above
    return nodes[0], records


def _height(n: int, levels: int) -> int:
    """Levels of a segment that n nodes of its group have at their foot."""
    height = 0
    while n > 1 and height < levels:
        n, height = -(-n // ARITY), height + 1
    return height


def _by_segment(rows: DataFrame, *then: str) -> DataFrame:
    keys = ("__group", "__block")
    return rows.repartition(*keys).sortWithinPartitions(*keys, *then)


def _ranked(rows: DataFrame, *order: str) -> DataFrame:
    """Stored rows with ``__rank`` from 0 in their ``__group``, and the group's size ``__n``.

    Rows are dealt by ranges of group and order and numbered within each task; the tasks' counts,
    at most one per task and group, shift the numbers. No group is gathered in one task.
    """
    dealt = rows.repartitionByRange("__group", *order).sortWithinPartitions("__group", *order)
    clean = dealt

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        group, nth = None, 0
        for batch in batches:
            numbers = []
            for here in batch.column("__group").to_pylist():
                if here != group:
                    group, nth = here, 0
                numbers.append(nth)
                nth += 1
            made = [pa.array([part] * batch.num_rows, pa.int32()), pa.array(numbers, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *made], [*batch.schema.names, "__part", "__nth"]
            )

    numbered = stage(clean.mapInArrow(run, schema_with(clean, __part="int", __nth="long")), "ranked")
    counts = numbered.groupBy("__group", "__part").agg(F.count("*").alias("__count"))
    whole = W.partitionBy("__group")
    before = whole.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select(
        "__group", "__part", "__count",
        F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__before"),
        F.sum("__count").over(whole).alias("__n"),
    )
    groups: Groups = settle_groups(shifts, ["__group", "__part"], "__count")[0]
    return (
        groups.join(numbered)
        .withColumn("__rank", F.col("__before") + F.col("__nth"))
        .drop("__part", "__nth", "__before", "__count")
    )


def _segments(nodes: DataFrame, levels: int) -> DataFrame:
    """One stored row per segment of the nodes (__group, __rank, __digest, __n) of a group."""
    block = F.expr(f"__rank div {ARITY**levels}").alias("__block")
    dealt = _by_segment(nodes.select("__group", block, "__rank", "__digest", "__n"), "__rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, foot, size = None, [], 0

        def made() -> list[dict]:
            digest, records = _fold(foot, size, levels)
            return [{
                "__group": key[0], "__block": key[1], "__digest": digest,
                "__records": [{"digest": d, "children": c} for d, c in records],
                "__width": size, "__n": -(-size // ARITY ** _height(size, levels)),
            }]

        for batch in batches:
            names = ("__group", "__block", "__digest", "__n")
            for group, block, digest, n in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
                if (group, block) != key:
                    if key is not None:
                        yield pa.RecordBatch.from_pylist(made(), schema)
                    key, foot, size = (group, block), [], n
                foot.append(digest)
        if key is not None:
            yield pa.RecordBatch.from_pylist(made(), schema)

    record = pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))])
    schema = pa.schema([
        ("__group", pa.string()), ("__block", pa.int64()), ("__digest", pa.string()),
        ("__records", pa.list_(record)), ("__width", pa.int64()), ("__n", pa.int64()),
    ])
    ddl = f"__group string, __block long, __digest string, __records {_RECORDS}, __width long, __n long"
    return stage(dealt.mapInArrow(run, ddl), "segments")


@dataclass(frozen=True)
class Tree:
    """The segments of all groups, those of the leaves first."""

    segments: list[DataFrame]
    levels: int

    @classmethod
    def build(cls, nodes: DataFrame, levels: int) -> Tree:
        segments = [_segments(nodes, levels)]
        while True:
            above = segments[-1].filter("__n > 1")
            if above.isEmpty():
                return cls(segments, levels)
            segments.append(_segments(above.withColumnRenamed("__block", "__rank"), levels))

    def tops(self) -> DataFrame:
        """(__group, __digest): the last node of every group."""
        tops = [s.filter("__n = 1").select("__group", "__digest") for s in self.segments]
        found = tops[0]
        for more in tops[1:]:
            found = found.unionByName(more)
        return found

    def records(self) -> DataFrame:
        """(digest, children): every inner node of the DAG once per place that it has."""
        each = [s.select(F.inline("__records")) for s in self.segments]
        found = each[0]
        for more in each[1:]:
            found = found.unionByName(more)
        return found

    def descend(self, starts: DataFrame, requests: DataFrame) -> DataFrame:
        """Requests (__group, __rank and more) with ``__digest``, the node found at that rank,
        ``__top`` and ``__path``. ``starts`` has (__group, __digest, __path) of the groups' last
        nodes. A path has one text per level: the siblings on the left, ``:``, those on the right.
        """
        found = None
        for k in reversed(range(len(self.segments))):
            segment = self.segments[k].drop("__n")
            first = self.segments[k].filter("__n = 1").select("__group", "__block", "__digest")
            entered = starts.join(first, ["__group", "__digest"]).withColumn("__top", F.col("__digest"))
            if found is not None:
                entered = entered.unionByName(found.withColumnRenamed("__rank", "__block"))
            opened = entered.join(segment, ["__group", "__block", "__digest"])
            asked = requests
            if k:
                place = F.expr(f"__rank div {ARITY ** (k * self.levels)}").alias("__rank")
                asked = requests.select("__group", place).distinct()
            found = self._walk(opened, asked)
            if k:
                found = stage(found, "descent")
        return found

    def _walk(self, opened: DataFrame, asked: DataFrame) -> DataFrame:
        """One segment further: opened segments and the requests for their feet, streamed together."""
        all_levels, width = self.levels, ARITY**self.levels
        inside = asked.withColumn("__block", F.expr(f"__rank div {width}"))
        kept = asked.schema.fields
        dealt = _by_segment(
            opened.unionByName(inside, allowMissingColumns=True), F.col("__digest").asc_nulls_last(), "__rank"
        )
        names = [f.name for f in kept]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            children, start, top, path, block, height = {}, "", "", [], 0, 0
            for batch in batches:
                opens = batch.column("__digest").is_valid().to_pylist()
                ranks = batch.column("__rank").to_pylist()
                made: list[tuple] = []
                for i, is_open in enumerate(opens):
                    if is_open:
                        row = batch.slice(i, 1).to_pylist()[0]
                        children = {r["digest"]: r["children"] for r in row["__records"]}
                        start, top, path = row["__digest"], row["__top"], row["__path"]
                        block, height = row["__block"], _height(row["__width"], all_levels)
                        continue
                    place = ranks[i] - block * width
                    node, levels = start, list(path)
                    for step in reversed(range(height)):
                        run_of = children[node]
                        digit = place // ARITY**step % ARITY
                        levels.append("".join(run_of[:digit]) + ":" + "".join(run_of[digit + 1 :]))
                        node = run_of[digit]
                    made.append((node, top, levels))
                if made:
                    rows = batch.filter(pa.array([not x for x in opens]))
                    columns = [pa.array(list(x), t) for x, t in zip(zip(*made), types, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [*(rows.column(n) for n in names), *columns],
                        [*names, "__digest", "__top", "__path"],
                    )

        types = (pa.string(), pa.string(), pa.list_(pa.string()))
        ddl = {"__digest": "string", "__top": "string", "__path": "array<string>"}
        empty = asked.sparkSession.createDataFrame([], StructType([
            StructField(f.name, f.dataType, True) for f in kept
        ]))
        return dealt.mapInArrow(run, schema_with(empty, **ddl))


@dataclass(frozen=True)
class Manifest:
    """The stored DAG of a dataset and its ranked leaves; ``root`` is None for an empty one."""

    root: str | None
    leaves: DataFrame
    tree: Tree
    groups: DataFrame
    group_tree: Tree | None

    def records(self) -> DataFrame:
        """(digest, children) of every inner node."""
        rows = self.tree.records()
        return rows if self.group_tree is None else rows.unionByName(self.group_tree.records())

    def proofs(self, requests: DataFrame | None = None) -> DataFrame:
        """All leaves, or requested ones, with ``leaf``, ``subroot``, ``root`` and ``path``.

        ``requests`` are rows of ``leaves``, filtered. Columns of these names among the kept ones
        are replaced.
        """
        asked = self.leaves if requests is None else requests
        wanted = asked.select("__group", "__rank", "__row")
        made = ("leaf", "subroot", "root", "path")
        kept = [f"__row.`{c}`" for c in asked.schema["__row"].dataType.names if c not in made]
        if self.group_tree is None:
            shape = wanted.select(*kept).limit(0)
            return shape.withColumns({
                **{c: F.lit(None).cast("string") for c in made[:3]},
                "path": F.lit(None).cast("array<string>"),
            })
        spark = asked.sparkSession
        start = spark.createDataFrame(
            [("", self.root, [])], "__group string, __digest string, __path array<string>"
        )
        entries = self.group_tree.descend(start, self.groups.select("__group", "__rank", "__of"))
        starts = stage(entries.select(F.col("__of").alias("__group"), "__digest", "__path"), "starts")
        return self.tree.descend(starts, wanted).select(
            *kept, F.col("__digest").alias("leaf"), F.col("__top").alias("subroot"),
            F.lit(self.root).alias("root"), F.col("__path").alias("path"),
        )


def build(
    rows: DataFrame, leaf: Column, group: Column, order: Column, keep: list[str], levels: int = LEVELS
) -> Manifest:
    """The manifest of a table: ``leaf`` is each row's digest, ``group`` and ``order`` its place.

    Groups go by their text, bytewise, and null is the first; within a group rows go by ``order``,
    null first, then by leaf. Rows that are equal in all of these are interchangeable: each is a
    leaf of its own. ``keep`` are the columns that proofs return. The rows are read once.
    """
    of = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    staged = stage(rows.select(
        F.struct(*(F.col(c) for c in keep)).alias("__row"), of.alias("__group"),
        order.alias("__order"), leaf.alias("__digest"), F.monotonically_increasing_id().alias("__tie"),
    ), "leaves")
    ranked = _ranked(staged, "__order", "__digest", "__tie").drop("__order", "__tie")
    if staged.isEmpty():
        return Manifest(None, ranked, Tree([], levels), ranked, None)
    tree = Tree.build(ranked, levels)
    subroots = stage(
        tree.tops().select(F.lit("").alias("__group"), F.col("__group").alias("__of"), "__digest"),
        "subroots",
    )
    groups = _ranked(subroots, "__of")
    group_tree = Tree.build(groups, levels)
    root = group_tree.tops().first()["__digest"]
    return Manifest(root, ranked, tree, groups, group_tree)
