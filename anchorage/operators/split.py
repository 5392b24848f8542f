"""Splitting, sampling and shuffling by a seeded hash of the key.

Membership depends on the key alone: no shuffle, the same on every run and every
engine, stable when rows are added, and all rows of one key stay together.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from anchorage.functions import hashing
from anchorage.sources import sinks


def by_hash(df, key, fractions, seed=42, out="split"):
    """Tag rows with a split name; ``fractions`` = {name: share}, summing to one."""
    if abs(sum(fractions.values()) - 1.0) > 1e-9:
        raise ValueError("split fractions must sum to 1")
    keys = [key] if isinstance(key, str) else list(key)
    slot = hashing.bucket(seed, *keys)
    names = list(fractions)
    tag, limit = None, 0.0
    for name in names[:-1]:
        limit += fractions[name]
        under = slot < F.lit(round(limit * hashing.BUCKETS))
        tag = F.when(under, name) if tag is None else tag.when(under, name)
    tag = F.lit(names[-1]) if tag is None else tag.otherwise(names[-1])
    return df.withColumn(out, tag)


CELLS = 1 << 14


def exact(df, key, fractions, seed=42, by=None, out="split", cells=CELLS):
    """Tag rows with a split whose number of keys is exact, in each stratum of ``by`` if given.

    Of n keys, the first floor(share * n + 1/2) by seeded hash belong to the first split,
    and so on by summed shares. Keys are counted in ``cells`` ranges of the hash, which are
    even whatever the keys; a key's place is that of its cell and its place within it, so no
    task ever sorts a whole stratum. A key with several values of ``by`` counts under the
    smallest. Null is a key and a stratum. Unlike ``by_hash``, membership changes as rows are added.
    """
    if abs(sum(fractions.values()) - 1.0) > 1e-9:
        raise ValueError("split fractions must sum to 1")
    keys = [key] if isinstance(key, str) else list(key)
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    stratum = F.min(by) if by else F.lit(0)
    groups = df.groupBy(*named).agg(stratum.alias("_by"))
    hashed = groups.withColumn("_h", hashing.position(seed, *[F.coalesce(F.col(f"_k{i}").cast("string"), F.lit("\0")) for i in range(len(keys))]))
    hashed = sinks.materialize(hashed.withColumn("_cell", F.floor(F.col("_h") / F.lit((1 << 60) // cells)).cast("long")))
    counts = hashed.groupBy(F.col("_by").alias("_s"), F.col("_cell").alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_s")  # a row per cell
    counts = counts.select("_s", "_c", (F.sum("_n").over(whole.orderBy("_c")) - F.col("_n")).alias("_before"), F.sum("_n").over(whole).alias("_all"))
    inside = Window.partitionBy("_by", "_cell").orderBy("_h", *[f"_k{i}" for i in range(len(keys))])
    placed = hashed.join(counts, (F.col("_cell") == F.col("_c")) & F.col("_by").eqNullSafe(F.col("_s")))
    place = F.col("_before") + F.row_number().over(inside)
    names, tag, limit = list(fractions), None, 0.0
    for name in names[:-1]:
        limit += fractions[name]
        under = F.col("_place") <= F.floor(F.col("_all") * limit + 0.5)
        tag = F.when(under, name) if tag is None else tag.when(under, name)
    tag = F.lit(names[-1]) if tag is None else tag.otherwise(names[-1])
    tags = placed.withColumn("_place", place).select(*[f"_k{i}" for i in range(len(keys))], tag.alias(out))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.drop(out).join(tags, same).select(*df.drop(out).columns, out)


def sample(df, key, frac, seed=42):
    """Keep a share of the keys, more than 0 and at most 1."""
    if not 0.0 < frac <= 1.0:
        raise ValueError(f"fraction must be in (0, 1], not {frac}")
    keys = [key] if isinstance(key, str) else list(key)
    return df.where(hashing.below(seed, keys, frac))


def shuffle(df, key, seed=42, out="shuffle_key"):
    """Rows in a seeded random order; the position column stays so the order can be rebuilt."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn(out, hashing.position(seed, *keys)).orderBy(out, *keys)


def features_label(df, label):
    """(features, label) frames."""
    return df.drop(label), df.select(label)
