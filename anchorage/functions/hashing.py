"""Seeded, engine-independent row hashes: the same key always lands in the same bucket."""

from pyspark.sql import functions as F

BUCKETS = 10_000


def _digits(text, start, length):
    return F.conv(F.substring(text, start, length), 16, 10).cast("bigint")


def key_text(seed, keys):
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.concat(F.lit(f"{seed}|"), F.concat_ws("|", *[c.cast("string") for c in cols]))


def bucket(seed, *keys):
    """0 .. 9,999 from the first 32 bits of the MD5 of seed and key."""
    return F.pmod(_digits(F.md5(key_text(seed, keys)), 1, 8), F.lit(BUCKETS))


def below(seed, keys, share):
    """Whether a key's bucket, refined by 52 more bits, lies under a share of all buckets."""
    whole = int(share * BUCKETS + 1e-9)
    rest = max(0, round((share * BUCKETS - whole) * (1 << 52)))
    slot = bucket(seed, *keys)
    fine = _digits(F.md5(key_text(seed, keys)), 9, 13)
    return (slot < F.lit(whole)) | ((slot == F.lit(whole)) & (fine < F.lit(rest)))


def position(seed, *keys):
    """60-bit hash used as a shuffling position."""
    return _digits(F.md5(key_text(seed, keys)), 1, 15)


def value_text(col, kind):
    """Text that differs for different values: JSON of nested ones, hex digits of bytes."""
    if kind == "binary":
        return F.hex(col)
    if kind.startswith(("array", "map", "struct")):
        return F.to_json(F.struct(F.col(col).alias("v")), {"ignoreNullFields": "false"})
    return F.col(col).cast("string")


def row_text(cols, kinds=None):
    """Unambiguous text of a row: each value prefixed by its length, nulls marked.

    ``kinds``: types by column, needed where some are nested or binary.
    """
    parts = []
    for c in cols:
        s = value_text(c, (kinds or {}).get(c, "string"))
        if (kinds or {}).get(c, "").startswith(("array", "map", "struct")):
            s = F.when(F.col(c).isNotNull(), s)
        parts.append(
            F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("~"))
        )
    return F.concat_ws("|", *parts)


def slices(digest):
    """Two 60-bit integers of a hex digest."""
    return _digits(digest, 1, 15), _digits(digest, 16, 15)
