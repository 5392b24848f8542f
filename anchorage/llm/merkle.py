"""Merkle manifest of a dataset by checkpoint and recompute.

Every row is a leaf. The leaves of a group stand in order, and every eight consecutive
nodes become their hash, up to the group's subroot; the subroots in order give the root
in the same way. Of all levels only every third is stored, one row per aligned subtree
of 512 nodes. A proof needs the levels between too: each subtree hashes its missing
interior nodes anew from the stored ones below, emits the siblings of its nodes, and
forgets the interior again. What lies above a subtree comes from the next stored level,
so paths are put together from the root down, a subtree at a time.

All of it is built-in expressions over one row per subtree; no group is ever in one row
or task as a whole.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from anchorage.llm.positions import numbered
from anchorage.llm.quality import let
from anchorage.sources import sinks

ARITY, STRIDE = 8, 3
WIDTH = ARITY**STRIDE


def field(column):
    """A value as its UTF-8 byte count, a colon and itself; null is a dash."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*columns):
    """Lowercase hex SHA-256 of the fields of a row."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def joined(nodes):
    """Hash of nodes in a row."""
    return F.sha2(F.array_join(nodes, ""), 256)


def _up(nodes):
    """The level above: hashes of every eight consecutive nodes."""
    last = F.floor((F.size(nodes) - 1) / ARITY).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: joined(F.slice(nodes, k * ARITY + 1, ARITY)))


def _levels(nodes, up=STRIDE):
    """A subtree's levels from its stored nodes upwards, each hashed once."""
    if not up:
        return F.array(nodes)
    return F.concat(F.array(nodes), let(_up(nodes), lambda above: _levels(above, up - 1)))


def _tops(items, sole):
    """The node that a subtree becomes: one level up at a time, a group's only subtree to its first single node."""
    climbed = let(
        F.transform(items, lambda x: x["_h"]),
        lambda nodes: let(
            _levels(nodes),
            lambda levels: F.when(sole, F.filter(levels, lambda x: F.size(x) == 1)[0][0]).otherwise(levels[STRIDE][0]),
        ),
    )
    return climbed


def _path(levels, j, sole):
    """Siblings before and after node ``j`` and its ancestors on each level within a subtree."""
    entries = []
    for level in range(STRIDE):
        k = F.floor(j / ARITY**level).cast("int")
        inside = k % ARITY
        nodes = levels[level]
        entry = F.struct(
            F.array_join(F.slice(nodes, k - inside + 1, inside), "").alias("before"),
            F.array_join(F.slice(nodes, k + 2, F.lit(ARITY - 1) - inside), "").alias("after"),
        )
        entries.append(F.when(~sole | (F.size(nodes) > 1), entry))
    return F.array_compact(F.array(*entries))


def fold(leaf, path):
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda own, p: F.sha2(F.concat(p["before"], own, p["after"]), 256))


def proof_digest(path):
    """Hash of all siblings of a path, from the leaf's level to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""), 256)


@dataclass
class Manifest:
    """Stored levels of the groups (``levels``) and of the tree over their subroots (``above``).

    A stored level has a row per subtree: ``_g``, ``_n`` (nodes of the group on that level),
    ``_sub`` and ``_items`` (``_i``, ``_h`` and, of the leaves, ``_keep``).
    """

    levels: list
    above: list


def _store(leaves):
    """The stored levels over numbered leaves, and the subroots (_g, _h)."""
    levels, tops = [], []
    most = leaves.agg(F.max("_n")).first()[0] or 1
    nodes = leaves
    while True:
        items = F.struct(*[c for c in ("_i", "_h", "_keep") if c in nodes.columns])
        grouped = nodes.groupBy("_g", F.floor(F.col("_i") / WIDTH).alias("_sub")).agg(
            F.first("_n").alias("_n"), F.array_sort(F.collect_list(items)).alias("_items")
        )
        levels.append(sinks.materialize(grouped))
        sole = F.col("_n") <= WIDTH
        up = levels[-1].select("_g", "_n", F.col("_sub").alias("_i"), _tops(F.col("_items"), sole).alias("_h"))
        tops.append(up.where(sole).select("_g", "_h"))
        if most <= WIDTH:
            break
        most = -(-most // WIDTH)
        nodes = up.where(~sole).withColumn("_n", F.ceil(F.col("_n") / WIDTH))
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.union(more)
    return levels, subroots


def build(rows, leaf, group, order, keep=()):
    """The manifest of a table.

    ``leaf`` is the digest column, ``group`` a column name, ``order`` names the columns that
    leaves ascend by within a group, ``keep`` those that proofs return beside them. Null is a
    group of its own and the first one; nulls come first in an order too. Rows equal in
    ``order`` follow their leaf. Repeated rows are leaves each. An empty table has no root.
    """
    leaves = rows.select(
        F.col(group).alias("_g"),
        F.struct(*order).alias("_o"),
        leaf.alias("_h"),
        F.struct(F.lit(True).alias("_any"), *keep).alias("_keep"),
    )
    levels, subroots = _store(numbered(leaves, "_g", ["_o", "_h"]).drop("_o"))
    subroots = subroots.select(
        F.lit(0).alias("_g"), F.col("_g").alias("_o"), "_h", F.struct(F.col("_g").alias("group"), F.col("_h").alias("subroot")).alias("_keep")
    )
    above, root = _store(numbered(subroots, "_g", ["_o"]).drop("_o"))
    return Manifest(levels, [above, sinks.materialize(root)])


def _proofs(levels, ends, wanted=None):
    """Leaves with their whole paths; ``ends`` has the path from each subroot (_g, _path, others)."""
    others = [c for c in ends.columns if c not in ("_g", "_path")]
    above = None
    tops = ends.select("_g", F.lit(0).cast("long").alias("_sub"), F.lit(True).alias("_sole"), "_path", *others)
    for depth, level in reversed(list(enumerate(levels))):
        known = tops if above is None else tops.union(above)
        known = known.select(F.col("_g").alias("_kg"), F.col("_sub").alias("_ks"), F.col("_sole").alias("_kl"), "_path", *others)
        here = level.withColumn("_sole", F.col("_n") <= WIDTH)
        if wanted is not None and depth == 0:
            here = here.where(F.exists("_items", lambda x: wanted(x["_keep"])))
        found = here.join(
            known, F.col("_g").eqNullSafe(F.col("_kg")) & (F.col("_sub") == F.col("_ks")) & (F.col("_sole") == F.col("_kl"))
        )
        nodes = let(
            F.transform("_items", lambda x: x["_h"]),
            lambda own: let(
                _levels(own, STRIDE - 1),
                lambda regenerated: F.transform(
                    "_items",
                    lambda x, j: F.struct(x.alias("x"), F.concat(_path(regenerated, j, F.col("_sole")), F.col("_path")).alias("path")),
                ),
            ),
        )
        found = found.select("_g", *others, F.explode(nodes).alias("_node"))
        if depth:
            above = found.select("_g", F.col("_node.x._i").alias("_sub"), F.lit(False).alias("_sole"), F.col("_node.path").alias("_path"), *others)
    return found


def prove(manifest, wanted=None):
    """Every leaf with its path to the root: the kept columns, ``group``, ``leaf``, ``path``, ``subroot``, ``root``.

    ``path`` has, level by level, the digests of the run's other nodes ``before`` and
    ``after``. ``wanted`` is a condition on the kept columns, for proofs of some leaves:
    subtrees without such a leaf are not hashed again.
    """
    above, root = manifest.above
    ends = root.select("_g", F.array().cast("array<struct<before string, after string>>").alias("_path"), F.col("_h").alias("root"))
    ends = _proofs(above, ends).select(
        F.col("_node.x._keep.group").alias("_g"), F.col("_node.path").alias("_path"), F.col("_node.x._keep.subroot").alias("subroot"), "root"
    )
    found = _proofs(manifest.levels, sinks.materialize(ends), wanted)
    if wanted is not None:
        found = found.where(wanted(F.col("_node.x._keep")))
    kept = [f.name for f in manifest.levels[0].schema["_items"].dataType.elementType["_keep"].dataType if f.name != "_any"]
    return found.select(
        *[F.col("_node.x._keep").getField(c).alias(c) for c in kept],
        F.col("_g").alias("group"),
        F.col("_node.x._h").alias("leaf"),
        F.col("_node.path").alias("path"),
        "subroot",
        "root",
    )
