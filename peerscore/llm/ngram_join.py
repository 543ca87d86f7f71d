"""N-gram Jaccard join: rare-first prefixes, length, positional and suffix filters, verified pairs.

The nodes of the join are the distinct shingle sets, so exact copies are one node. Shingles are
ordered from rare to frequent; two sets with enough in common must share a shingle of their
prefixes. First every set is compared with the one pivot that most of its prefix shingles name,
which links groups of near copies at a cost of one comparison a set. Shingles with the same
smallest set form a group; the sets of a group that is still in several components are compared
inside a task, by signatures and then, where those leave a doubt, on the whole sets. No pair becomes a
row before it is a link. Large groups are dealt to several tasks, block by block.
""" 

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscore.llm import arrays
from peerscore.llm.components import components
from peerscore.llm.frames import schema_with
from peerscore.session import scratch_root, settle_groups, stage

#: Hashed cells that hold the level (about 4 log2) of the most frequent shingle in them.
CELLS, CHUNK = 1 << 24, 1 << 16
#: Shingles are counted in runs of so many, and reported if a run has them so often.
RUN, OFTEN = 3_000_000, 2
#: Longs of a set's signature for the suffix filter: one bit for each hash value that occurs.
LONGS = 32
#: Bits of the filter that keeps texts which are in no pair from being shuffled.
BITS = 1 << 25
#: Sets of a group that a task compares with each other, or with as many others.
BLOCK = 2048


def _key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set; the first 64 name it."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return (
        int.from_bytes(digest[:8], "little", signed=True),
        int.from_bytes(digest[8:], "little", signed=True),
    )


def shingled(docs: DataFrame, text: str, keep: list[str], words: int) -> DataFrame:
    """The columns of ``keep`` with n (size of the set), node and check (its key), bits (its
    signature) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, at in arrays.chunks(batch.column(text)):
                sets = list(arrays.shingle_sets(data, at, words))
                keys = [_key(x) for x in sets]
                piece = batch.slice(row, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(c) for c in keep), pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([k[0] for k in keys], pa.int64()),
                        pa.array([k[1] for k in keys], pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(sets) + 1) * LONGS, pa.int32()),
                            pa.array(np.concatenate([_signature(x) for x in sets]).view(np.int64)),
                        ),
                    ],
                    [*keep, "n", "node", "check", "bits"],
                )

    schema = schema_with(
        docs.select(*keep), n="long", node="long", check="long", bits="array<bigint>"
    )
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def frequent_shingles(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """The levels of frequent shingles, in CELLS cells, one byte each, whatever the data's size.

    Every document counts, copies in one task once. Tasks count exactly within runs of RUN shingles
    and report those that a run has several times, so rare shingles are not shuffled. The order of
    shingles that follows is only as good as these counts, but any order gives the same links.
    """

    def counted(found: list[np.ndarray]) -> pa.RecordBatch:
        tokens, n = np.unique(np.concatenate(found), return_counts=True)
        often = n >= OFTEN
        return pa.RecordBatch.from_arrays(
            [pa.array(arrays.signed(tokens[often])), pa.array(n[often])], ["token", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, size, seen = [], 0, set()
        for batch in batches:
            for _, data, at in arrays.chunks(batch.column(0)):
                for found in arrays.shingle_sets(data, at, words):
                    if len(found) and (node := _key(found)[0]) not in seen:
                        seen.add(node)
                        buffer.append(found)
                        size += len(found)
                if size >= RUN:
                    yield counted(buffer)
                    buffer, size = [], 0
        if buffer:
            yield counted(buffer)

    def packed(table: pa.Table) -> pa.Table:
        levels = np.zeros(CHUNK, dtype=np.uint8)
        cells = table.column("cell").to_numpy() & (CHUNK - 1)
        levels[cells] = np.minimum(4 * np.log2(table.column("n").to_numpy()), 255)
        first = int(table.column("cell")[0].as_py()) // CHUNK
        return pa.table({"chunk": pa.array([first]), "levels": pa.array([levels.tobytes()])})

    tokens = docs.select(text).mapInArrow(run, "token long, n long")
    cells = (
        tokens.groupBy("token").agg(F.sum("n").alias("n"))
        .groupBy(F.col("token").bitwiseAND(F.lit(CELLS - 1)).alias("cell")).agg(F.max("n").alias("n"))
    )
    chunk = F.shiftright("cell", 16).alias("chunk")  # CHUNK rows at most
    levels = np.zeros(CELLS, dtype=np.uint8)
    for row in cells.groupBy(chunk).applyInArrow(packed, "chunk long, levels binary").collect():
        at = row["chunk"] * CHUNK
        levels[at : at + CHUNK] = np.frombuffer(row["levels"], dtype=np.uint8)
    return levels


def _levels(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """0 for rare shingles, more for frequent ones."""
    return frequent[(found & np.uint64(CELLS - 1)).view(np.int64)]


def _prefixes(docs: DataFrame, text: str, words: int, percent: int, order) -> DataFrame:
    """(token, node, n, at): the prefix shingles of each set, in the global rare-first order.

    A task emits a set once, however many of its rows have it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, emitted = order.value, set()
        for batch in batches:
            for _, data, at in arrays.chunks(batch.column(0)):
                tokens, nodes, sizes, places = [], [], [], []
                for found in arrays.shingle_sets(data, at, words):
                    if not len(found) or (node := _key(found)[0]) in emitted:
                        continue
                    emitted.add(node)
                    n = len(found)
                    ordered = found[np.argsort(_levels(found, frequent), kind="stable")]
                    prefix = ordered[: n + (-percent * n // 100) + 1]
                    tokens.append(prefix)
                    nodes.append(np.full(len(prefix), node, dtype=np.int64))
                    sizes.append(np.full(len(prefix), n, dtype=np.int64))
                    places.append(np.arange(len(prefix), dtype=np.int64))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(arrays.signed(np.concatenate(tokens)))]
                        + [pa.array(np.concatenate(x)) for x in (nodes, sizes, places)],
                        ["token", "node", "n", "at"],
                    )

    # size and place share a long, to shuffle less
    found = docs.select(text).mapInArrow(run, "token long, node long, n long, at long")
    return found.select("token", "node", F.shiftleft("n", 32).bitwiseOR(F.col("at")).alias("n_at"))


def _shared(postings: DataFrame, percent: int) -> DataFrame:
    """(group, node, pivot), for each token and set with another set of a like size.

    Tokens are sorted by size within partitions and streamed, so a frequent token needs no more
    memory. ``group`` is the token's smallest set. ``pivot`` is the first of the sets whose size is
    of the same step of a scale, if it passes the positional filter, else null. Length filter: a
    set with any larger partner of a like size has one next to it. Two linked sets share a token
    within the index prefix of the smaller one, which is shorter than the prefix: the least number
    of shingles in common grows with the size of the larger one.
    """
    scale = np.log(100 / percent) / 2

    def first(new: np.ndarray, values: np.ndarray, held) -> np.ndarray:
        """The value of the first row of each run; of the first run that of the batches before."""
        start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        found = values[start]
        return found if held is None else np.where(start == 0, held, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last row so far, its group and pivot, and the size of the indexed set before it
        held, lead, pivot, size, near = None, None, (None, None), 0, False

        def made(node, group, pivots, n_at, keep) -> pa.RecordBatch:
            n, at, m, other = n_at >> 32, n_at & 0xFFFFFFFF, pivots[1] >> 32, pivots[1] & 0xFFFFFFFF
            common = np.minimum(at, other) + np.minimum(n - at, m - other)
            could = (100 * common >= percent * (n + m - common)) & (pivots[0] != node)
            return pa.RecordBatch.from_arrays(
                [pa.array(group[keep]), pa.array(node[keep]),
                 pa.array(pivots[0][keep], mask=~could[keep])], ["group", "node", "pivot"],
            )

        for batch in batches:
            columns = [x.to_numpy() for x in batch.columns]
            if held is not None:
                columns = [np.append(h, x) for h, x in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            again = (columns[0][1:] == columns[0][:-1]) & (columns[1][1:] == columns[1][:-1])
            token, node, n_at = (x[np.append(True, ~again)] for x in columns)
            n, at = n_at >> 32, n_at & 0xFFFFFFFF
            rows = np.arange(len(n))
            same = np.append(False, token[1:] == token[:-1])
            like = same[1:] & (100 * n[:-1] >= percent * n[1:])
            indexed = at <= n + (-2 * percent * n // (100 + percent))
            start = np.maximum.accumulate(np.where(same, 0, rows))
            last = np.append(-1, np.maximum.accumulate(np.where(indexed, rows, -1))[:-1])
            sizes = np.where(last >= start, n[last], np.where(start == 0, size, 0))
            before = 100 * sizes >= percent * n
            step = np.floor(np.log(n) / scale)
            group = first(~same, node, lead)
            new = ~same | np.append(True, step[1:] != step[:-1])
            pivots = first(new, node, pivot[0]), first(new, n_at, pivot[1])
            keep = np.append(before[:-1] | (indexed[:-1] & like), False)
            yield made(node, group, pivots, n_at, keep)
            held, near, size = [x[-1:] for x in (token, node, n_at)], bool(before[-1]), sizes[-1]
            lead, pivot = group[-1], (pivots[0][-1], pivots[1][-1])
        if held is not None and near:
            yield made(
                held[1], np.array([lead]), [np.array([x]) for x in pivot], held[2], np.array([True])
            )

    dealt = postings.repartition("token").sortWithinPartitions("token", "n_at", "node")
    return dealt.mapInArrow(run, "group long, node long, pivot long")


def _texts(docs: DataFrame, text: str, words: int, nodes: DataFrame) -> DataFrame:
    """(node, words): the text of each of these nodes, once.

    A bit array of fixed size keeps most other texts from being shuffled; the join is exact.
    """
    sc = docs.sparkSession.sparkContext
    place = F.col("node").bitwiseAND(F.lit(BITS - 1))
    found = (
        nodes.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit AS int))")).alias("bits"))
        .toPandas()  # BITS / 64 rows at most
    )
    bits = np.zeros(BITS // 64, dtype=np.int64)
    bits[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    wanted = sc.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, emitted = wanted.value, set()
        for batch in batches:
            texts = batch.column(0)
            for row, data, at in arrays.chunks(texts):
                rows, nodes = [], []
                for i, found in enumerate(arrays.shingle_sets(data, at, words), row):
                    node = _key(found)[0] if len(found) else None
                    if node is None or node in emitted:
                        continue
                    place = node & (BITS - 1)
                    if int(bits[place >> 6]) >> (place & 63) & 1:
                        emitted.add(node)
                        rows.append(i)
                        nodes.append(node)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), texts.take(pa.array(rows, pa.int64()))],
                    ["node", "words"],
                )

    kept = docs.select(text).mapInArrow(run, "node long, words string")
    return (
        kept.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("words").alias("words"))
    )


def _signature(found: np.ndarray) -> np.ndarray:
    """A bit for each value of the shingles' hashes modulo the number of bits."""
    bits = np.zeros(64 * LONGS, dtype=bool)
    bits[(found % np.uint64(64 * LONGS)).view(np.int64)] = True
    return np.packbits(bits).view(np.uint64)


def _enough(common: Column, n: Column, m: Column, percent: int) -> Column:
    return F.lit(100) * common >= F.lit(percent) * (n + m - common)


def _verified(
    pairs: DataFrame, signs: DataFrame, texts_of, words: int, percent: int
) -> DataFrame:
    """The links (a, b) among candidate pairs (a, b), each compared once, on whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = 256
            for row in range(0, batch.num_rows, step):
                part = batch.slice(row, step)
                left, right = (
                    [s for _, data, at in arrays.chunks(part.column(c))
                     for s in arrays.shingle_sets(data, at, words)]
                    for c in ("words_a", "words_b")
                )
                linked = []
                for x, y in zip(left, right, strict=True):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * common >= percent * (len(x) + len(y) - common))
                yield part.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    a, b = (
        signs.select(*(F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "bits")))
        .withColumnRenamed(f"node_{x}", x) for x in ("a", "b")
    )

    def alone(x: str, y: str) -> Column:
        """Shingles that only one of two sets can have: bits that the other doesn't have."""
        return F.expr(
            f"aggregate(zip_with(bits_{x}, bits_{y}, (x, y) -> bit_count(x & ~y)), 0, (s, x) -> s + x)"
        )

    n, m = F.col("n_a"), F.col("n_b")
    most = F.least(n - alone("a", "b"), m - alone("b", "a"))  # the suffix filter
    near = stage(
        pairs.join(b, "b").join(a, "a").filter(_enough(most, n, m, percent)).select("a", "b"), "near"
    )
    nodes = near.select(F.col("a").alias("node")).union(near.select("b")).distinct()
    texts = texts_of(nodes)
    left, right = (
        texts.select(F.col("node").alias(x), F.col("words").alias(f"words_{x}")) for x in ("a", "b")
    )
    return (
        near.join(right, "b").join(left, "a").select("a", "b", "words_a", "words_b")
        .mapInArrow(run, "a long, b long")
    )


def _by_pivot(shared: DataFrame) -> DataFrame:
    """(a, b): for each set b the pivot a that most of its tokens name."""
    votes = shared.filter("pivot IS NOT NULL").groupBy("node", "pivot").count()
    best = votes.groupBy("node").agg(F.max(F.struct("count", "pivot")).alias("best"))
    return best.select(F.col("best.pivot").alias("a"), F.col("node").alias("b"))


def _groups(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(group, node, component): the members of the groups that are in more than one component."""
    members = shared.select("group", "node").distinct()
    known = members.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    several = (
        known.groupBy("group").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size")
        )
        .filter("lo < hi").select("group", "size")
    )
    groups, _ = settle_groups(several, ["group"], "size")  # a large group stays where it is
    return groups.join(known).select("group", "node", "component")


def _dealt(members: DataFrame) -> DataFrame:
    """Members with i, j and own: the pair of blocks that they are compared in, and which is theirs.

    A group of up to BLOCK members is one block. A member of a larger one goes to all pairs of
    blocks with its own.
    """
    sizes = members.groupBy("group").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    busy, _ = settle_groups(sizes.withColumn("blocks", blocks).filter("blocks > 1"), ["group"], "size")
    return (
        busy.join(members, "left").drop("size").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
        .drop("blocks", "other")
    )


class _Block:
    """Sets that a task compares; those of one component are not compared again."""

    def __init__(self, node, component, own, size, bits, percent: int):
        self.node, self.root, self.own = node, component.copy(), own
        self.size, self.bits, self.percent = size, bits, percent
        self.one = bool((own == own[0]).all())

    def candidates(self, a: int, after: np.ndarray) -> np.ndarray:
        """Those of ``after`` that may link with a: length filter, then suffix filter."""
        n = self.size[a]
        after = after[self.root[after] != self.root[a]]
        m = self.size[after]
        after = after[100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)]
        if not len(after):
            return after
        m, mine, theirs = self.size[after], self.bits[a], self.bits[after]
        common = np.minimum(
            n - np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64),
            m - np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64),
        )
        return after[100 * common >= self.percent * (n + m - common)]

    def pairs(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each set with the later ones, or with those of the other block."""
        everyone = np.arange(len(self.node))
        if self.one:
            for a in everyone[:-1]:
                yield a, self.candidates(a, everyone[a + 1 :])
            return
        first = self.own[0]
        right = everyone[self.own != first]
        for a in everyone[self.own == first]:
            yield a, self.candidates(a, right)

    def doubtful(self) -> np.ndarray:
        """The sets that may link with one of another component."""
        found = np.zeros(len(self.node), dtype=bool)
        for a, others in self.pairs():
            found[a] |= len(others) > 0
            found[others] = True
        return np.flatnonzero(found)

    def links(self, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        """Pairs of linked sets, enough to connect all that are linked."""
        for a, others in self.pairs():
            for b in others.tolist():
                if self.root[a] == self.root[b]:
                    continue
                x, y = sets[a], sets[b]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= self.percent * (len(x) + len(y) - common):
                    yield self.node[a], self.node[b]
                    self.root[self.root == self.root[b]] = self.root[a]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each group and pair of blocks, which come sorted."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("group", "i", "j")])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if held and tuple(keys[:, a]) != key:
                yield pa.Table.from_batches(held)
                held = []
            key = tuple(keys[:, a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _block(table: pa.Table, size: np.ndarray, bits: np.ndarray, percent: int) -> _Block:
    node, component, own = (
        table.column(c).to_numpy() for c in ("node", "component", "own")
    )
    return _Block(node, component, own, size, bits, percent)


def _in_groups(
    members: DataFrame, signs: DataFrame, texts_of, words: int, percent: int
) -> DataFrame:
    """Links (a, b) that connect the sets of each group; sets are compared whole where in doubt."""

    def doubt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            table = table.combine_chunks()
            bits = table.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64)
            block = _block(
                table, table.column("n").to_numpy(), bits.reshape(-1, LONGS), percent
            )
            found = table.take(pa.array(block.doubtful()))
            yield from found.select(["group", "node", "component"]).to_batches()

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            table = table.combine_chunks()
            sets = [
                x for _, data, at in arrays.chunks(table.column("words").combine_chunks())
                for x in arrays.shingle_sets(data, at, words)
            ]
            size = np.array([len(x) for x in sets])
            bits = np.stack([_signature(x) for x in sets])
            found = list(_block(table, size, bits, percent).links(sets))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

    def together(rows: DataFrame) -> DataFrame:
        by = ("group", "i", "j")
        return rows.repartition(*by).sortWithinPartitions(*by)

    left = stage(
        together(_dealt(members).join(signs, "node"))
        .mapInArrow(doubt, "group long, node long, component long").distinct(), "doubtful",
    )
    texts = texts_of(left.select("node").distinct())
    return together(_dealt(left).join(texts, "node")).mapInArrow(link, "a long, b long")


def _signatures(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, bits) of these sets; copies of a text are one row a task before any shuffle."""
    each = rows.groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    return each.join(nodes, "node", "left_semi")


def node_components(
    docs: DataFrame, rows: DataFrame, text: str = "text", words: int = 5, percent: int = 75
) -> DataFrame:
    """(node, component) of every set that is linked with another one; ``rows`` are the shingled
    documents, stored."""
    spark = docs.sparkSession
    scratch_root(spark)
    order = spark.sparkContext.broadcast(frequent_shingles(docs, text, words))
    shared = stage(_shared(_prefixes(docs, text, words, percent, order), percent), "postings")
    signs = stage(_signatures(rows, shared.select("node").distinct()), "signatures")

    def texts_of(nodes: DataFrame) -> DataFrame:
        return stage(_texts(docs, text, words, nodes), "texts")

    none = spark.createDataFrame([], "node long, component long")
    links = stage(_verified(_by_pivot(shared), signs, texts_of, words, percent), "links")
    labels = stage(_merged(none, links), "labels")
    members = stage(_groups(shared, labels), "groups")
    links = stage(_in_groups(members, signs, texts_of, words, percent), "links")
    return stage(_merged(labels, links), "labels")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after new links between nodes, which may stand for components."""
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    old = ends.join(labels, "node", "left").select(
        F.col("node").alias("a"), F.coalesce("component", "node").alias("b")
    )
    merged = components(links.select("a", "b").union(old))
    kept = (
        labels.join(
            merged.select(F.col("node").alias("component"), F.col("component").alias("now")),
            "component", "left",
        )
        .select("node", F.coalesce("now", "component").alias("component"))
    )
    return kept.unionByName(merged).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 5, percent: int = 75
) -> DataFrame:
    """(id, text_hash, n_shingles, component_id, representative) of every row.

    Two texts link when they share at least ``percent`` percent of the union of their distinct
    ``words``-word shingles, A-Z lower-cased; a component's id is its smallest row id. The rows
    with the smallest id, and of these the smallest hash of the text, represent their component.

    * Null or wordless text: an empty set, linked with nothing; it represents itself.
    * Fewer words than a shingle: the whole sequence is the one shingle.
    * Null ids are a component's id only if all of its ids are null.
    * Repeated rows are copies; rows equal in id and text represent together or not at all.
    * An empty table gives an empty table. Other columns are not read.
    """
    keyed = docs.select(F.col(id_col), F.col(text), F.xxhash64(text).alias("text_hash"))
    rows = stage(shingled(keyed, text, [id_col, "text_hash"], words), "sets")
    labels = node_components(docs, rows, text, words, percent)
    # Neither a text nor a component with very many rows lands in one task.
    copies = rows.groupBy("node").agg(F.count("*").alias("copies"))
    nodes, _ = settle_groups(labels.join(copies, "node"), ["node"], "copies")
    of_row = F.when(F.col("n") > 0, F.coalesce("component", "node"))
    known = stage(
        nodes.join(rows.drop("bits"), "left").drop("copies").withColumn("class", of_row), "classes"
    )
    row = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "text_hash")
    least = known.filter("class IS NOT NULL").groupBy("class").agg(
        F.min(row).alias("least"), F.count("*").alias("members")
    )
    classes, _ = settle_groups(least, ["class"], "members")
    empty = F.col("class").isNull()
    first = F.col(id_col).eqNullSafe(F.col("least.id")) & F.col("text_hash").eqNullSafe(
        F.col("least.text_hash")
    )
    return classes.judge(known, ~empty).select(
        id_col, "text_hash", F.col("n").alias("n_shingles"),
        F.when(empty, F.col(id_col)).otherwise(F.col("least.id")).alias("component_id"),
        (empty | first).alias("representative"),
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 5, percent: int = 75
) -> DataFrame:
    """The rows that represent their component of near duplicates, once each, with all columns.

    See ``near_duplicates`` for nulls, empty texts and ties. Rows with an empty set stay.
    """
    found = near_duplicates(docs, id_col, text, words, percent).filter("NOT representative")
    drop = found.select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    keyed = docs.withColumn("__hash", F.xxhash64(text))
    same = keyed[id_col].eqNullSafe(drop["__id"]) & (keyed["__hash"] == drop["__hash"])
    kept = keyed.join(drop, same, "left_anti")
    empty = F.length(F.translate(F.coalesce(F.col(text), F.lit("")), " \t\n\x0b\f\r", "")) == 0
    return (
        kept.filter(~empty).dropDuplicates([id_col, "__hash"]).unionByName(kept.filter(empty))
        .drop("__hash")
    )
