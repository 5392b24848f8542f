"""Prefix trie of conversations by a splitter skeleton.

A conversation is the row of its turns' digests, its path; copies are counted first, so that
each different path stands once. Paths are dealt out by ranges: the splitters between the
ranges come from a sample, and the trie of the splitters, the skeleton, is broadcast. A
node that is no prefix of a splitter has all its paths in one range, so the sorted range
finishes it on its own, from a stack. A skeleton node gets a partial aggregate from every
range that touches it; these are reduced, and the skeleton, which is small whatever the
input, is rolled up once.

Turns are the same if role and text have the same 128-bit digest.
"""

import hashlib
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from anchorage.llm.common import sorted_groups
from anchorage.llm.positions import numbered
from anchorage.sources import sinks

TOKEN = 16  # bytes of a turn's digest
CHUNK = 4096  # ids in a row while they are brought together
SHARD_TURNS, MOST_SHARDS, SAMPLES = 1 << 13, 1 << 14, 8
SKELETON = 1 << 21  # turns in all sampled paths: at most 32 MB, and 1 / SAMPLES of it in the splitters


def paths(turns, conv="conv_id", order="turn", role="role", text="text"):
    """One row per conversation: ``_c``, ``_path`` (digests of its turns) and ``_sizes`` (code points of each).

    Turns stand by ``order``, null first; equal ones by role and digest. Null role and text
    count as empty. A row without a conversation id belongs to none and is left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("_c"),
        F.struct(F.col(order), role).alias("_o"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * TOKEN)).alias("_t"),
        F.length(text).alias("_s"),
    )
    # a long conversation comes together from chunks
    chunks = (
        numbered(rows, "_c", ["_o", "_t"])
        .groupBy("_c", F.floor(F.col("_i") / CHUNK).alias("_k"))
        .agg(F.array_sort(F.collect_list(F.struct("_i", "_t", "_s"))).alias("_x"))
        .select("_c", "_k", F.col("_x._t").alias("_t"), F.col("_x._s").alias("_s"))
        .groupBy("_c")
        .agg(F.array_sort(F.collect_list(F.struct("_k", "_t", "_s"))).alias("_x"))
    )
    return chunks.select("_c", F.flatten("_x._t").alias("_tokens"), F.flatten("_x._s").alias("_sizes")).mapInPandas(
        _packed, "_c long, _path binary, _sizes binary"
    )


def _packed(batches):
    for batch in batches:
        yield pd.DataFrame(
            {
                "_c": batch["_c"],
                "_path": [b"".join(t) for t in batch["_tokens"]],
                "_sizes": [np.asarray(s, "<i4").tobytes() for s in batch["_sizes"]],
            }
        )


def rebuilt(rows, base, shared, most):
    """Conversations that begin as another one: the first ``shared`` turns of ``base``, then their own after as many.

    Both are columns made of ``_c``; ``shared`` is ``most`` at most. An absent base has no turns.
    """
    wanted = rows.select(base.alias("_b")).distinct()
    heads = rows.select(
        F.col("_c").alias("_b"),
        F.substring("_path", 1, most * TOKEN).alias("_head_path"),
        F.substring("_sizes", 1, most * 4).alias("_head_sizes"),
    ).join(wanted, "_b", "left_semi")
    found = rows.withColumns({"_b": base, "_h": shared.cast("int")}).join(heads, "_b", "left")

    def begun(name, size):
        head, own = F.col(f"_head{name}"), F.col(name)
        first = F.coalesce(head.substr(F.lit(1), F.col("_h") * size), F.lit(b""))
        return F.concat(first, own.substr(F.col("_h") * size + 1, F.octet_length(own))).alias(name)

    return found.select("_c", begun("_path", TOKEN), begun("_sizes", 4))


def _ends(batches):
    """SHA-256 over the chunks of ids of each path, which lie sorted."""
    held, state = None, None
    for batch in batches:
        rows = []
        for key, ids in zip(batch["_key"], batch["_ids"]):
            if key != held:
                if held is not None:
                    rows.append((held, state.hexdigest()))
                held, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pd.DataFrame(rows, columns=["_key", "_ends"])
    if held is not None:
        yield pd.DataFrame([(held, state.hexdigest())], columns=["_key", "_ends"])


def distinct_paths(rows):
    """Each different path once: its smallest conversation, how many have it, and the hash of their ids."""
    keyed = numbered(rows.withColumn("_key", F.sha2("_path", 256)), "_key", ["_c"])
    keyed = sinks.materialize(keyed)
    several = (
        keyed.where("_n > 1")
        .groupBy("_key", F.floor(F.col("_i") / CHUNK).alias("_k"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("_c")), lambda c: c.cast("string")), ",").alias("_ids"))
        .repartition("_key")
        .sortWithinPartitions("_key", "_k")
        .select("_key", "_ids")
        .mapInPandas(_ends, "_key string, _ends string")
    )
    first = keyed.where("_i = 0").join(several, "_key", "left")
    alone = F.sha2(F.col("_c").cast("string").cast("binary"), 256)
    return first.select("_path", "_sizes", "_c", "_n", F.coalesce("_ends", alone).alias("_ends"))


# --- the skeleton


def splitters(rows, shard_turns=SHARD_TURNS):
    """Paths that cut the table into ranges of about ``shard_turns`` turns, from a hash sample of bounded size."""
    turns = F.octet_length("_path") / TOKEN + 1
    n, total = rows.agg(F.count(F.lit(1)), F.sum(turns)).first()
    shards = min(MOST_SHARDS, -(-int(total or 0) // shard_turns))
    if shards < 2:
        return []
    most = SKELETON // (SAMPLES * shards)
    share = min(1.0, SAMPLES * shards / n)
    # a sampled path is cut where the sample would grow too large; any sequence of turns is a boundary
    sample = (
        rows.where(F.pmod(F.xxhash64("_path"), F.lit(1 << 30)) < int(share * (1 << 30)))
        .select(F.substring("_path", 1, most * TOKEN).alias("p"), turns.alias("w"))
        .orderBy(F.xxhash64("_path"))
        .limit(2 * SAMPLES * shards)
        .toPandas()
        .sort_values("p")
    )
    if not len(sample):
        return []
    weight = np.cumsum(sample["w"].to_numpy())
    at = np.searchsorted(weight, weight[-1] * np.arange(1, shards) / shards)
    return sorted({bytes(p) for p in sample["p"].iloc[np.minimum(at, len(sample) - 1)]} - {b""})


def skeleton(splits):
    """The trie of the splitters: for each node its number by (parent's number, turn); the root is 0."""
    nodes = {}
    for s in splits:
        at = 0
        for k in range(0, len(s), TOKEN):
            at = nodes.setdefault((at, s[k : k + TOKEN]), len(nodes) + 1)
    return nodes


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "_skeleton", "_size"]
RESULT_TYPES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, _skeleton long, _size long"
NO_ONE = hashlib.sha256(b"").hexdigest()


class _Node:
    __slots__ = ("conv", "convs", "children", "leaves", "saved", "ends", "size", "skeleton", "waiting")

    def __init__(self, size, skeleton):
        self.conv, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.size, self.skeleton, self.waiting = None, size, skeleton, []


def _shared(a, b):
    """Turns that two paths have in common at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TOKEN
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax()) // TOKEN


class _Shard:
    """The trie of one range, from its paths in order."""

    def __init__(self, known):
        self.known, self.out = known, []
        self.stack, self.path = [_Node(0, 0)], b""

    def add(self, path, sizes, conv, n, ends):
        keep = _shared(self.path, path)
        while len(self.stack) > keep + 1:
            self.close()
        for k in range(keep, len(path) // TOKEN):
            above = self.stack[-1].skeleton
            number = None if above is None else self.known.get((above, path[k * TOKEN : (k + 1) * TOKEN]))
            self.stack.append(_Node(int(sizes[k]), number))
        node, self.path = self.stack[-1], path
        node.conv = conv if node.conv is None else min(node.conv, conv)
        node.convs += n
        node.ends = ends

    def close(self):
        node, depth = self.stack.pop(), len(self.stack)
        up = self.stack[-1] if self.stack else None
        if node.skeleton is not None:  # a part; the rest is in other ranges
            self.out.append((node.conv, depth, None, node.convs, node.children, node.leaves, node.saved, node.ends, node.skeleton, node.size))
        else:
            node.leaves = node.leaves or 1
            node.saved += (node.convs - 1) * node.size
            self.out += [(c, d, node.conv, *rest) for c, d, *rest in node.waiting]
            row = (node.conv, depth, node.convs, node.children, node.leaves, node.saved, node.ends or NO_ONE)
            up.children += 1
            if up.skeleton is None:
                up.waiting.append((*row, None, None))
            else:  # its number stands for the parent's conversation, which is known later
                self.out.append((*row[:2], None, *row[2:], up.skeleton, None))
            up.leaves += node.leaves  # what skeleton nodes pass on is added when all their parts are
            up.saved += node.saved
        if up is not None:
            up.conv = node.conv if up.conv is None else min(up.conv, node.conv)
            up.convs += node.convs

    def finish(self):
        while self.stack:
            self.close()
        return self.out


def _frame(rows):
    kinds = {c: "object" if c == "ends_sha256" else "Int64" for c in RESULT}  # long ids are no floats
    return pd.DataFrame({c: pd.array([r[i] for r in rows], kinds[c]) for i, c in enumerate(RESULT)})


def _local(known):
    def run(batches):
        for group in sorted_groups(batches, ["_shard"]):
            shard = _Shard(known.value)
            for path, sizes, conv, n, ends in group[["_path", "_sizes", "_c", "_n", "_ends"]].itertuples(index=False):
                shard.add(path, np.frombuffer(sizes, "<i4"), conv, n, ends)
            out = shard.finish()
            for k in range(0, len(out), 10000):
                yield _frame(out[k : k + 10000])

    return run


def _dealt(splits):
    def run(batches):
        for batch in batches:
            yield batch.assign(_shard=[bisect_right(splits.value, p) for p in batch["_path"]])

    return run


def _rolled_up(known):
    """Whole aggregates of the skeleton's nodes from the reduced ones, deepest first."""

    def run(batches):
        parent = {number: above for (above, _), number in known.value.items()}
        nodes = {int(r["_skeleton"]): r for batch in batches for r in batch.to_dict("records")}
        for i in nodes:
            if i in parent:
                nodes[parent[i]]["n_children"] += 1
        for i in sorted(nodes, key=lambda i: -nodes[i]["depth"]):
            node = nodes[i]
            if not node["n_children"]:
                node["n_leaves"] = 1
            node["saved_tokens"] += (node["n_convs"] - 1) * node["_size"]
            node["ends_sha256"] = node["ends_sha256"] or NO_ONE
            if i in parent:
                above = nodes[parent[i]]
                node["parent_conv_id"] = above["conv_id"]
                above["n_leaves"] += node["n_leaves"]
                above["saved_tokens"] += node["saved_tokens"]
        if nodes:
            yield _frame([[r.get(c) for c in RESULT] for r in nodes.values()])

    return run


def trie(rows, shard_turns=SHARD_TURNS):
    """All nodes of the prefix trie of conversations (``_c``, ``_path``, ``_sizes``).

    Returns conv_id (the smallest of those that begin with the node's turns), depth,
    parent_conv_id (of the root: null), n_convs, n_children, n_leaves, saved_tokens (over the
    subtree, the copies of each node's last text beyond the first, in code points) and
    ends_sha256 (of the ids of the conversations that end there, in order, joined by commas).
    Conversations without a turn belong to the root alone. No conversations, no nodes.
    """
    spark = rows.sparkSession
    rows = sinks.materialize(distinct_paths(rows))
    splits = splitters(rows, shard_turns)
    cuts, known = spark.sparkContext.broadcast(splits), spark.sparkContext.broadcast(skeleton(splits))
    local = (
        rows.mapInPandas(_dealt(cuts), "_path binary, _sizes binary, _c long, _n long, _ends string, _shard int")
        .repartition("_shard")
        .sortWithinPartitions("_shard", "_path")
        .mapInPandas(_local(known), RESULT_TYPES)
    )
    local = sinks.materialize(local)
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    reduced = local.where("_size is not null").groupBy("_skeleton").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in sums],
        F.max("ends_sha256").alias("ends_sha256"),
        F.first("_size").alias("_size"),
    )
    # as many rows as the splitters have prefixes, whatever the input
    whole = sinks.materialize(reduced.repartition(1).mapInPandas(_rolled_up(known), RESULT_TYPES))
    above = whole.select("_skeleton", F.col("conv_id").alias("_above"))
    rest = local.where("_size is null").join(F.broadcast(above), "_skeleton", "left")
    columns = [c for c in RESULT if not c.startswith("_")]
    return rest.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).select(*columns).union(whole.select(*columns))
