"""Document fingerprints: bottom-k sketches of shingle hashes.

A fingerprint holds the ``k`` smallest of the 64-bit hashes of a text's distinct shingles,
sorted, as hex digits. Sketches of parts merge to the sketch of the whole, and two of
them tell resemblance, containment and the number of distinct shingles.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from anchorage.llm.common import U64, shingles
from anchorage.sources import sinks

K, WIDTH = 64, 5
# documents with neighbouring ids are worked on together; a bucket has so many ids at most
BUCKET = 512


def sketch(text, k=K, n=WIDTH):
    """The ``k`` smallest shingle hashes of a text, sorted; a short text is one shingle."""
    return shingles(text, n)[:k]


def merge(*sketches, k=K):
    """Sketch of all parts together."""
    return np.unique(np.concatenate([np.zeros(0, U64), *sketches]))[:k]


def distinct(s, k=K):
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(len(s)) if len(s) < k else (k - 1) / ((float(s[k - 1]) + 1) / 2.0**64)


def resemblance(a, b, k=K):
    """Estimated Jaccard similarity; of two empty sketches 1, of one 0. Exact while both are below ``k``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, k=k)
    return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True)) / len(union)


def containment(a, b, k=K):
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    r = resemblance(a, b, k)
    both = distinct(merge(a, b, k=k), k) * r
    return min(1.0, both / distinct(a, k))


def to_text(s):
    return s.astype(">u8").tobytes().hex()


def from_text(s):
    return np.frombuffer(bytes.fromhex(s), ">u8").astype(U64)


def fingerprints(docs, id_col="doc_id", text_col="text", k=K, n=WIDTH):
    """id, n_chars, fingerprint and n_distinct of every row. A null text counts as empty."""

    def run(batches):
        for batch in batches:
            found = [sketch(t, k, n) for t in batch["_text"]]
            yield pd.DataFrame(
                {
                    id_col: batch["_id"],
                    "n_chars": [len(t) for t in batch["_text"]],
                    "fingerprint": [to_text(s) for s in found],
                    "n_distinct": [distinct(s, k) for s in found],
                }
            )

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return texts.mapInPandas(run, f"`{id_col}` {kind}, n_chars long, fingerprint string, n_distinct double")


def merged_fingerprints(parts, key, fingerprint_col="fingerprint", k=K):
    """One fingerprint per key from fingerprints of its parts.

    A null or empty fingerprint adds nothing. Of each key the ``k`` smallest distinct hashes
    are kept before and after the shuffle, so a key of many parts is never gathered.
    """
    step = 16
    hashes = F.expr(
        f"transform(sequence(0, length({fingerprint_col}) div {step} - 1), "
        f"i -> substr({fingerprint_col}, i * {step} + 1, {step}))"
    )
    small = parts.where(F.length(fingerprint_col) > 0).select(key, F.explode(hashes).alias("_h")).distinct()
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_h"))
    few = small.withColumn("_rank", rank).where(F.col("_rank") <= k).groupBy(key).agg(F.collect_list("_h").alias("_h"))
    joined = few.select(F.col(key).alias("_key"), F.array_join(F.array_sort("_h"), "").alias("_f"))
    keys = parts.select(key).distinct()
    return keys.join(joined, keys[key].eqNullSafe(joined["_key"]), "left").select(
        key, F.coalesce("_f", F.lit("")).alias("fingerprint")
    )


def next_texts(docs, id_col="doc_id", text_col="text"):
    """Rows (_bucket, _own, _id, _text), dealt by bucket and sorted so that a text's next one,
    in descending order of ids, follows it; the last of a bucket is not its own.

    A bucket holds a fixed range of ids. Its last text needs the first of the next bucket
    that is not empty: those first texts are sent twice. Only ids go through the window
    that finds these buckets, one row per bucket.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.where("_id is not null").withColumn("_bucket", F.floor(F.col("_id") / BUCKET).cast("long"))
    heads = rows.groupBy("_bucket").agg(F.max("_id").alias("_id"))
    # neighbours of buckets: inside groups of 4096, and between groups by their ends
    group = F.floor(F.col("_bucket") / 4096)
    inside = Window.partitionBy("_group").orderBy("_bucket")
    linked = heads.withColumn("_group", group).withColumn("_above", F.lead("_bucket").over(inside))
    ends = linked.groupBy("_group").agg(F.min("_bucket").alias("_low"), F.max("_bucket").alias("_high"))
    across = Window.orderBy("_group")
    ends = ends.select(
        "_group",
        F.coalesce(F.lead("_low").over(across), F.first("_low").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_next"),
    )
    # the first text of a bucket goes to the bucket above, that of the highest to the lowest
    goes = linked.join(ends, "_group").select("_id", F.coalesce("_above", "_next").alias("_to"))
    goes = sinks.materialize(goes)  # its size decides how the texts are joined: they stay where they are if it is small
    sent = rows.select("_id", "_text").join(goes, "_id").select(
        F.col("_to").alias("_bucket"), F.lit(False).alias("_own"), "_id", "_text"
    )
    own = rows.select("_bucket", F.lit(True).alias("_own"), "_id", "_text")
    # the order within equal ids is by text, and of several texts sent the greatest is next
    return (
        own.union(sent)
        .repartition("_bucket")
        .sortWithinPartitions("_bucket", F.desc("_own"), F.desc("_id"), F.desc("_text"))
    )


def edited(text, following):
    """The last half of the code points gives way to the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _follow(k, n):
    def row(now, after):
        i, text, a = now
        mixed = edited(text, after[1])
        b, c = sketch(mixed, k, n), after[2]
        return (
            i,
            len(text),
            hashlib.sha256(mixed.encode("utf-8", "surrogatepass")).hexdigest(),
            to_text(a),
            to_text(b),
            resemblance(a, b, k),
            resemblance(a, c, k),
        )

    names = ["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        held = None  # (bucket, (id, text, sketch)) that waits for the next text
        for batch in batches:
            rows = []
            for bucket, own, i, text in batch[["_bucket", "_own", "_id", "_text"]].itertuples(index=False):
                here = (i, text, sketch(text, k, n))
                if held is not None and held[0] == bucket:
                    rows.append(row(held[1], here))
                held = (bucket, here) if own else None
            yield pd.DataFrame(rows, columns=names)

    return run


EDITED = (
    "_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edit_likeness(docs, id_col="doc_id", text_col="text", k=K, n=WIDTH):
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has the text's last half replaced by the beginning of the next document
    (descending ids; after the last the first). Integer ids; of rows with one id those with
    the greater text come first. A single document follows itself. A null text is empty, and
    two empty texts are alike. A row without id is left out. One row per row.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return next_texts(docs, id_col, text_col).mapInPandas(_follow(k, n), EDITED).select(
        F.col("_id").cast(kind).alias(id_col), *[c.split()[0] for c in EDITED.split(", ")[1:]]
    )
