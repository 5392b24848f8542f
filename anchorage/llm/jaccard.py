"""N-gram Jaccard join: MinHash buckets, Bayesian pruning of candidates, exact verification.

Texts with equal shingle sets form a class, and only one of each class goes on. Banded
MinHash values form buckets; buckets with the same members are kept once. A bucket is
cut into blocks, and each pair of blocks is one unit of work, so a large group of near
copies spreads over many tasks. Inside a unit the MinHash values are compared a few at
a time, and a pair is dropped as soon as the posterior probability of reaching the
threshold is below the tolerance; the others are verified on their whole shingle sets.
Units give link counts and a spanning forest, never pairs.
"""

from hashlib import blake2b
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from anchorage.llm import components
from anchorage.llm.common import U64, mix, shingles, sorted_groups
from anchorage.sources import sinks

# 32 bands of 4 values: a pair at 0.8 meets in no band once in 2 * 10**7 pairs
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
MISSED = 1e-6  # the most pairs at the threshold that may meet in no band
# a block holds this many texts, or texts of this many shingles, on average
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 1 << 20

_SEEDS = np.random.default_rng(7).integers(1, 1 << 63, HASHES, dtype=U64) | U64(1)


def minhash(keys):
    """HASHES minima, 32 bits each, of a non-empty set of 64-bit keys."""
    out = np.full(HASHES, np.iinfo(U64).max, dtype=U64)
    for i in range(0, len(keys), 512):
        x = keys[i : i + 512, None] * _SEEDS
        x ^= x >> U64(32)
        x *= U64(0xD6E8FEB86659FD93)
        np.minimum(out, x.min(axis=0), out=out)
    return (out >> U64(32)).astype(np.uint32)


def require_bands(threshold):
    """Stops at a threshold whose pairs the bands would lose too often."""
    missed = (1 - threshold**ROWS) ** BANDS
    if missed > MISSED:
        raise ValueError(f"at threshold {threshold}, {missed:.1e} of the pairs meet in no band; {MISSED:.0e} may")


def least_matches(threshold, tolerance, step):
    """For each number of compared values, the fewest matches that keep a pair.

    With a uniform prior, m matches of n give Beta(m + 1, n - m + 1) for the similarity;
    the pair stays while P(similarity >= threshold) >= tolerance.
    """
    out = []
    for n in range(step, HASHES + 1, step):
        reach = [
            sum(comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))
            for m in range(n + 1)
        ]
        out.append((n, next(m for m in range(n + 1) if reach[m] >= tolerance)))
    return out


def candidates(a, b, band, plan, same):
    """Index pairs that meet first in this band and survive the pruning; same: a is b."""
    found = []
    for i0 in range(0, len(a), 256):
        part = a[i0 : i0 + 256]
        for j0 in range(0, len(b), 256):
            if same and j0 + 256 <= i0:
                continue
            other = b[j0 : j0 + 256]
            hit = np.ones((len(part), len(other)), dtype=bool)
            for r in range(band * ROWS, (band + 1) * ROWS):
                hit &= part[:, r, None] == other[None, :, r]
            i, j = np.nonzero(hit)
            if same:
                keep = i + i0 < j + j0
                i, j = i[keep], j[keep]
            if band and len(i):
                early = part[i, : band * ROWS] == other[j, : band * ROWS]
                first = ~early.reshape(len(i), band, ROWS).all(axis=2).any(axis=1)
                i, j = i[first], j[first]
            matches, done = np.zeros(len(i), dtype=np.int64), 0
            for n, least in plan:
                matches += (part[i, done:n] == other[j, done:n]).sum(axis=1)
                keep, done = matches >= least, n
                i, j, matches = i[keep], j[keep], matches[keep]
            found.append((i + i0, j + j0))
    return [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (list(zip(*found)) or [(), ()])]


def overlap(sets, i, j):
    """Sizes of the intersections of the sets of pairs i, j."""
    if len(i) <= 2 * len(sets):
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j)], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keys, col, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    keep = shared[col]
    owner, col = owner[keep], place[col[keep]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 4096
    for c0 in range(0, int(shared.sum()), width):  # counts stay below 2**24, where float32 is exact
        lo, hi = np.searchsorted(col, [c0, c0 + width])
        m = np.zeros((len(sets), width), dtype=np.float32)
        m[owner[lo:hi], col[lo:hi] - c0] = 1
        total += m @ m.T
    return total[i, j].astype(np.int64)


def forest(n, i, j):
    """The smallest index linked to each of n."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _sketches(n):
    def run(batches):
        for batch in batches:
            rows = []
            for i, text in zip(batch["_id"], batch["_text"]):
                s = shingles(text, n)
                if len(s):
                    sig = minhash(s)
                    key = blake2b(s.tobytes(), digest_size=16).digest()
                    rows.append((i, key, len(s), sig.tobytes()))
            yield pd.DataFrame(rows, columns=["_id", "_key", "_size", "_sig"])

    return run


def _bands(batches):
    weights = mix(np.arange(1, ROWS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
    for batch in batches:
        if not len(batch):
            continue
        sig = np.frombuffer(b"".join(batch["_sig"]), dtype=np.uint32).reshape(-1, BANDS, ROWS)
        bucket = mix((sig.astype(U64) * weights).sum(axis=2, dtype=U64)) >> U64(6)
        bucket |= np.arange(BANDS, dtype=U64) << U64(58)
        yield pd.DataFrame(
            {
                "_bucket": bucket.astype(np.int64).ravel(),
                "_class": np.repeat(batch["_class"].to_numpy(), BANDS),
                "_size": np.repeat(batch["_size"].to_numpy(), BANDS),
            }
        )


def _distinct(group):
    """Without repeated rows; of an id with several texts each text once."""
    if len(set(group["_class"])) == len(group):
        return group
    return group.drop_duplicates(["_class", "_sig"])


def _sides(group):
    """Signatures of a unit's two sides, and whether they are one."""
    sig = np.frombuffer(b"".join(group["_sig"]), dtype=np.uint32).reshape(-1, HASHES)
    left = (group["_block"] == group["_i"]).to_numpy()
    one = bool(group["_i"].iloc[0] == group["_j"].iloc[0])
    return sig, np.flatnonzero(left), np.arange(len(sig)) if one else np.flatnonzero(~left), one


def _unit_pairs(group, plan):
    sig, left, right, one = _sides(group)
    band = int(group["_bucket"].iloc[0]) >> 58
    i, j = candidates(sig[left], sig[right], band, plan, one)
    i, j = left[i], right[j]
    ids = group["_class"].to_numpy()
    other = ids[i] != ids[j]
    return i[other], j[other], ids


UNIT = ["_bucket", "_i", "_j"]


def _prune(plan):
    def run(batches):
        for group in map(_distinct, sorted_groups(batches, UNIT)):
            i, j, _ = _unit_pairs(group, plan)
            if len(i):
                yield group.iloc[np.unique(np.r_[i, j])]

    return run


def _verify(n, threshold, plan):
    def run(batches):
        for group in sorted_groups(batches, UNIT):
            if len(set(group["_class"])) < len(group):  # a row may have got the text of another row of its id
                own = [len(x) > 0 and minhash(x).tobytes() == s for x, s in zip((shingles(t, n) for t in group["_text"]), group["_sig"])]
                group = _distinct(group[own])
            i, j, ids = _unit_pairs(group, plan)
            if not len(i):
                continue
            sets = [shingles(t, n) for t in group["_text"]]
            size = np.array([len(s) for s in sets])
            near = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
            i, j = i[near], j[near]
            common = overlap(sets, i, j)
            near = common >= threshold * (size[i] + size[j] - common) - 1e-9
            i, j = i[near], j[near]
            if len(i):
                links = np.bincount(np.r_[i, j], minlength=len(ids))
                order = np.argsort(ids, kind="stable")  # so that roots are smallest ids
                rank = np.empty_like(order)
                rank[order] = np.arange(len(order))
                root = ids[order][forest(len(ids), rank[i], rank[j])][rank]
                some = links > 0
                yield pd.DataFrame({"_class": ids[some], "_links": links[some], "_root": root[some]})

    return run


def _by_unit(df):
    """Rows of a unit next to each other, units dealt out by hash."""
    return df.repartition(*UNIT).sortWithinPartitions(*UNIT, "_class")


def join(docs, id_col="doc_id", text_col="text", n=5, threshold=0.8, tolerance=1e-6, step=16):
    """Class, number of links and group of every document.

    ``class_id``: smallest id among the texts with the same set of ``n``-word shingles.
    ``n_links``: classes of other sets whose Jaccard similarity is ``threshold`` or more.
    ``group_id``: smallest id among all that links connect.

    One row per row of ``docs``, repeated rows included. A null text, or one without a
    word, is alone (class and group are its id, no links); a text shorter than ``n``
    words is one shingle. A row without id takes no part and gets nulls and no links.
    An id that comes with several texts is one document, in one class per text; its
    rows carry the smallest of these classes. Other columns are ignored.

    A threshold at which more than MISSED of the pairs would meet in no band is an error.
    """
    require_bands(threshold)
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    known = docs.where("_id is not null and _text is not null")
    id_type = docs.schema["_id"].dataType.simpleString()
    plan = least_matches(threshold, tolerance, step)
    sketches = sinks.materialize(
        known.mapInPandas(_sketches(n), f"_id {id_type}, _key binary, _size long, _sig binary")
    )
    classes = sketches.groupBy("_key").agg(F.min("_id").alias("_class"))
    firsts = classes.select("_key", F.col("_class").alias("_id"))
    one = sinks.materialize(
        sketches.join(firsts, ["_key", "_id"], "left_semi")
        .dropDuplicates(["_key"])
        .select(F.col("_id").alias("_class"), "_size", "_sig")
    )
    bands = one.mapInPandas(_bands, f"_bucket long, _class {id_type}, _size long")
    buckets = (
        bands.groupBy("_bucket")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("_size").alias("_weight"),
            F.bit_xor(F.xxhash64("_class")).alias("_x"),
            F.bit_xor(F.xxhash64("_class", F.lit(1))).alias("_y"),
        )
        .where("_n > 1")
        # buckets of the same members: the one of the first band stands for all
        .groupBy("_n", "_x", "_y", "_weight")
        .agg(F.min("_bucket").alias("_bucket"))
        .select(
            "_bucket",
            F.greatest(
                F.ceil(F.col("_n") / BLOCK_TEXTS), F.ceil(F.col("_weight") / BLOCK_SHINGLES)
            ).alias("_blocks"),
        )
    )
    members = sinks.materialize(
        bands.select("_bucket", "_class")
        .join(buckets, "_bucket")
        .withColumn("_block", F.pmod(F.xxhash64("_class", F.lit(2)), F.col("_blocks")))
    )
    # every unordered pair of blocks, with the sides that a text is on
    units = members.select(
        "_bucket", "_class", "_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_o")
    ).select(
        "_bucket",
        F.least("_block", "_o").alias("_i"),
        F.greatest("_block", "_o").alias("_j"),
        "_block",
        "_class",
    )
    schema = f"_bucket long, _i long, _j long, _block long, _class {id_type}, _sig binary"
    pruned = _by_unit(units.join(one.select("_class", "_sig"), "_class")).select(
        "_bucket", "_i", "_j", "_block", "_class", "_sig"
    )
    needed = sinks.materialize(pruned.mapInPandas(_prune(plan), schema))
    texts = known.select(F.col("_id").alias("_class"), "_text")
    wanted = needed.join(texts, "_class")
    verified = sinks.materialize(
        _by_unit(wanted)
        .select("_bucket", "_i", "_j", "_block", "_class", "_sig", "_text")
        .mapInPandas(_verify(n, threshold, plan), f"_class {id_type}, _links long, _root {id_type}")
    )
    links = verified.groupBy("_class").agg(F.sum("_links").alias("_links"))
    edges = verified.where("_class != _root").select(F.col("_class").alias("a"), F.col("_root").alias("b"))
    groups = components.smallest(edges)
    found = (
        sketches.select("_id", "_key")
        .join(classes, "_key")
        .groupBy("_id")
        .agg(F.min("_class").alias("_class"))
        .join(links, "_class", "left")
        .join(groups.select(F.col("node").alias("_class"), F.col("root").alias("_group")), "_class", "left")
    )
    return docs.select("_id").join(found, "_id", "left").select(
        F.col("_id").alias(id_col),
        F.coalesce("_class", "_id").alias("class_id"),
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_group", "_class", "_id").alias("group_id"),
    )
