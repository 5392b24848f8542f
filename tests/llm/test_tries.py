"""The prefix trie against a plain loop, with and without a skeleton, on odd and empty input."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from anchorage.llm import tries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def turns_by_force(rows):
    """conv -> [(role, text)] in order"""
    found = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            found.setdefault(c, []).append(((turn is not None, turn or 0), role, sha(f"{len(role.encode())}:{role}{text}"), text))
    return {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in found.items()}


def rebuilt_by_force(own):
    out = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + x[h:]
    return out


def trie_by_force(convs):
    members = {}
    for c, x in convs.items():
        for d in range(len(x) + 1):
            members.setdefault(tuple(x[:d]), []).append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out.append((min(cs), len(p), up, len(cs), children[p], leaves[p], saved[p], sha(ends)))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, _c string"


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(11)
    said = ["hello", "", "é日", None, "ok", "x" * 50]
    rows = []
    for c in range(400):
        if c % 3 == 0:  # a large group of copies
            rows += [(c, k, "user", f"the same {k}") for k in range(4)]
        else:
            n = rng.randint(1, 9)
            rows += [(c, rng.choice([None, k, k, k // 2]), rng.choice(["user", "bot", None]), rng.choice(said)) for k in range(n)]
    rows += [(500, k, "user", f"long {k}") for k in range(9000)] + [(501, k, "user", f"long {k}") for k in range(8000)]
    rows += [(None, 1, "user", "nobody"), (7, 1, "user", "x"), (7, 1, "user", "x"), (-3, 0, "bot", "negative")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [40, 3000, 1 << 20])
def test_trie_is_that_of_a_plain_loop(spark, turns, shard_turns):
    few = [r for r in turns if r[0] is None or r[0] < 500]
    rows = tries.paths(spark.createDataFrame([(*r, "x") for r in few], SCHEMA))
    found = sorted(map(tuple, tries.trie(rows, shard_turns).collect()), key=repr)
    assert found == trie_by_force(turns_by_force(few))


def test_long_paths(spark, turns):
    rows = tries.paths(spark.createDataFrame([(*r, "x") for r in turns], SCHEMA))
    assert {r["_c"]: len(r["_path"]) // 16 for r in rows.collect()} == {c: len(x) for c, x in turns_by_force(turns).items()}
    nodes = tries.trie(rows, 5000).where("conv_id >= 500")
    assert nodes.count() == 9000 and nodes.where("n_convs = 2").count() == 8000
    top = nodes.where("depth = 1").first()
    assert top.n_leaves == 1 and top.saved_tokens == sum(len(f"long {k}") for k in range(8000))


def test_rebuilt_conversations(spark, turns):
    few = [r for r in turns if r[0] is None or r[0] < 500]
    own = tries.paths(spark.createDataFrame([(*r, "x") for r in few], SCHEMA))
    shared = F.crc32(F.col("_c").cast("string").cast("binary")) % 6
    rows = tries.rebuilt(own, F.col("_c") - F.col("_c") % 100, shared, most=5)
    want = turns_by_force(few)
    want.pop(-3)  # Python's remainder differs
    want = trie_by_force(rebuilt_by_force(want))
    assert sorted(map(tuple, tries.trie(rows.where("_c >= 0"), 100).collect()), key=repr) == want


def test_skeleton_holds_the_prefixes_of_the_splitters():
    a, b, c = (bytes([k]) * 16 for k in range(3))
    known = tries.skeleton([a + b, a + c, b])
    assert len(known) == 4 and known[known[0, a], c] and (0, c) not in known


def test_no_conversations(spark):
    assert tries.trie(tries.paths(spark.createDataFrame([], SCHEMA))).collect() == []
    nobody = spark.createDataFrame([(None, 1, "a", "b", None)], SCHEMA)
    assert tries.trie(tries.paths(nobody)).collect() == []
