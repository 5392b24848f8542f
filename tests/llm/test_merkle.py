"""The Merkle manifest against a plain loop, on odd, empty and larger input."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from anchorage.llm import merkle, positions


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def digest(*values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """Root, and each node's siblings (before, after), level by level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for k, own in enumerate(owners):
            first = k - k % 8
            for i in own:
                paths[i].append(("".join(nodes[first:k]), "".join(nodes[k + 1 : first + 8])))
        owners = [sum(owners[k : k + 8], []) for k in range(0, len(owners), 8)]
        nodes = [sha(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
    return nodes[0] if nodes else None, paths


def by_force(rows):
    """(id, group, text) rows -> (id, leaf, path, subroot, root)"""
    nulls = lambda x: (x is not None, x)
    groups = {}
    for i, g, text in rows:
        groups.setdefault(g, []).append((i, digest(i, g, text)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (nulls(x[0]), x[1]))
    subroots = {g: tree([h for _, h in groups[g]]) for g in order}
    root, above = tree([subroots[g][0] for g in order])
    return [
        (i, leaf, path + above[k], subroots[g][0], root)
        for k, g in enumerate(order)
        for (i, leaf), path in zip(groups[g], subroots[g][1])
    ]


def manifest_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(7)
    leaf = merkle.digest(F.col("doc_id"), F.col("lang"), F.col("text"))
    return merkle.build(docs, leaf, "lang", ["doc_id"], keep=["doc_id"])


def proofs(found):
    return sorted(
        ((r.doc_id, r.leaf, [(p.before, p.after) for p in r.path], r.subroot, r.root) for r in found.collect()), key=repr
    )


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    rows = [(i, "en", f"Text {i}") for i in range(4200)]  # four levels and an uneven end
    rows += [(i, "de", None if i % 9 == 0 else "") for i in range(513)]
    rows += [(i, "lone", "é" * i) for i in range(1)] + [(i, None, "x") for i in range(9)]
    rows += [(None, "en", "no id"), (None, None, None), (7, "en", "Text 7"), (7, "en", "another text")]  # ties, repeated rows
    rng.shuffle(rows)
    return rows


def test_proofs_are_those_of_a_plain_loop(spark, odd_rows):
    found = merkle.prove(manifest_of(spark, odd_rows))
    assert proofs(found) == sorted(by_force(odd_rows), key=repr)
    checked = found.select(
        (merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"),
        (merkle.fold(F.sha2("leaf", 256), F.col("path")) == F.col("root")).alias("forged"),
        merkle.proof_digest(F.col("path")).alias("d"),
        F.array_join(F.transform("path", lambda p: F.concat(p["before"], p["after"])), "").alias("all"),
    ).collect()
    assert all(r.ok and not r.forged and r.d == sha(r.all) for r in checked)


def test_proofs_of_some_leaves(spark, odd_rows):
    manifest = manifest_of(spark, odd_rows)
    some = merkle.prove(manifest, lambda kept: kept["doc_id"] % 1000 == 3)
    assert proofs(some) == sorted((r for r in by_force(odd_rows) if r[0] is not None and r[0] % 1000 == 3), key=repr)


def test_only_every_third_level_is_stored(spark, odd_rows):
    manifest = manifest_of(spark, odd_rows)
    stored = [level.agg(F.sum(F.size("_items"))).first()[0] for level in manifest.levels]
    assert stored == [len(odd_rows), -(-4203 // 512) + -(-513 // 512)]


def test_small_and_empty_tables(spark):
    assert proofs(merkle.prove(manifest_of(spark, []))) == []
    for rows in ([(1, None, None)], [(1, "a", "x"), (1, "a", "x")], [(i, str(i), "x") for i in range(70)]):
        assert proofs(merkle.prove(manifest_of(spark, rows))) == sorted(by_force(rows), key=repr)


def test_clashing_names(spark):
    rows = spark.createDataFrame([(i, "a", "b", "c") for i in range(20)], "_i long, _g string, path string, _h string")
    leaf = merkle.digest(F.col("_i"), F.col("path"))
    found = merkle.prove(merkle.build(rows, leaf, "_g", ["_i"], keep=["_i", "_h"]))
    assert found.columns == ["_i", "_h", "group", "leaf", "path", "subroot", "root"]
    assert found.where(merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).count() == 20


def test_positions_of_one_big_group(spark):
    rows = spark.range(5000).select(F.lit("one").alias("g"), (F.col("id") * 7919 % 5003).alias("v"), F.lit(None).cast("int").alias("_c"))
    found = positions.numbered(rows, "g", ["v"]).collect()
    assert [r.v for r in sorted(found, key=lambda r: r["_i"])] == sorted(r.v for r in found)
    assert sorted(r["_i"] for r in found) == list(range(5000)) and {r["_n"] for r in found} == {5000}
