"""Merkle manifests against a plain tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from peerscore.llm import merkle

SCHEMA = "doc_id long, lang string, text string, n long, leaf string, path int, __rank int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*fields):
    return h(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def proof(levels, i):
    found = []
    for level in levels[:-1]:
        found.append((level[i - 1], "") if i % 2 else ("", level[i + 1] if i + 1 < len(level) else ""))
        i //= 2
    return found


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(*row[:4]), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    found = []
    for at, g in enumerate(names):
        for i, (_, _, leaf, row) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = proof(trees[g], i) + proof(top, at)
            found.append((row[0], leaf, trees[g][-1][0], top[-1][0], "".join(a + b for a, b in steps)))
    return sorted(found, key=repr)


def rows(n):
    rng = random.Random(8)
    langs = [None, "", "a", "é", "b", "zz", *["en"] * 12]
    made = [
        (None if k % 97 == 5 else 7 * k % 1009, rng.choice(langs), rng.choice(["x", None, "", "é" * 50]), k % 3 or None,
         "own", k, -k)
        for k in range(n)
    ]
    made.append((5, "alone", "x", 1, "own", 0, 0))
    return [*made, made[n // 2], made[n // 2]]


def manifest(df, levels=10):
    leaf = merkle.digest_of(*map(F.col, ("doc_id", "lang", "text", "n")))
    return merkle.build(df, leaf, F.col("lang"), F.col("doc_id"), df.columns, levels)


@pytest.mark.parametrize(("size", "levels"), [(1, 10), (40, 10), (1700, 10), (300, 2), (300, 3)])
def test_proofs_equal_a_plain_tree(spark, size, levels):
    given = rows(size)
    found = manifest(spark.createDataFrame(given, SCHEMA).repartition(5), levels)
    proofs = found.proofs().withColumns({
        "siblings": merkle.siblings(F.col("path")), "again": merkle.folded(F.col("leaf"), F.col("path")),
        "forged": merkle.folded(F.sha2("leaf", 256), F.col("path")),
    })
    got = proofs.collect()
    key = ("doc_id", "leaf", "subroot", "root", "siblings")
    assert sorted((tuple(r[c] for c in key) for r in got), key=repr) == brute(given)
    assert {r["again"] for r in got} == {found.root}
    assert found.root not in {r["forged"] for r in got}
    assert set(got[0].asDict()) >= {"doc_id", "lang", "text", "n", "__rank"}


def test_records_form_the_dag(spark):
    given = rows(200)
    found = manifest(spark.createDataFrame(given, SCHEMA))
    children = {r["digest"]: r["children"] for r in found.records().collect()}
    assert all(digest == h(*of) for digest, of in children.items())
    leaves, todo = [], [found.root]
    while todo:
        node = todo.pop()
        leaves += [] if node in children else [node]
        todo += children.get(node, [])
    assert sorted(leaves) == sorted(leaf_of(*r[:4]) for r in given)


def test_requests_for_some_leaves(spark):
    found = manifest(spark.createDataFrame(rows(1500), SCHEMA))
    some = found.leaves.filter("__rank % 400 = 3")
    everything = {(r["doc_id"], r["leaf"], tuple(r["path"])) for r in found.proofs().collect()}
    asked = [(r["doc_id"], r["leaf"], tuple(r["path"])) for r in found.proofs(some).collect()]
    assert 0 < len(asked) == some.count() and set(asked) <= everything


def test_an_empty_table_has_no_root(spark):
    found = manifest(spark.createDataFrame([], SCHEMA))
    assert found.root is None
    assert found.proofs().columns[-4:] == ["leaf", "subroot", "root", "path"]
    assert found.proofs().count() == 0


def test_equal_rows_fill_many_segments(spark):
    """Half of the rows are one row; each has a place and a proof of its own."""
    given = [(1, "en", "same", 1, "", 0, 0)] * 200 + rows(200)
    got = manifest(spark.createDataFrame(given, SCHEMA), 3).proofs().withColumn(
        "siblings", merkle.siblings(F.col("path"))
    )
    key = ("doc_id", "leaf", "subroot", "root", "siblings")
    assert sorted((tuple(r[c] for c in key) for r in got.collect()), key=repr) == brute(given)


def test_crc_is_unsigned(spark):
    ids = [0, 3, 7, 123456789]
    got = spark.createDataFrame([(i,) for i in ids], "i long").select(F.crc32(F.col("i").cast("string")))
    assert [r[0] for r in got.collect()] == [zlib.crc32(str(i).encode()) for i in ids]
