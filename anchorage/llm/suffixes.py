"""Suffix dedup by bucket refinement: bytes under a string that an earlier document holds too.

Not all suffixes are sorted, but a set of anchors: of every ``length``-byte window the
place of its smallest ``GRAM``-byte hash, so that equal windows have equal anchors at equal
places. Anchors with equal grams form the initial buckets. A bucket is refined by sorting
on identifiers of later (and earlier) offsets: first on the whole stretch of windows that
belong to an anchor, which settles all of them at once if a smaller document has it;
what stays open is refined by the grams beside the anchor, and only stretches that
agree there with another one go down to their single windows, in the same bucket. All
identifiers come from one sum over the document's bytes, whatever the offset.

A batch of documents settles among its own first, and sends on one entry for each
stretch (of its smallest document). A bucket with many stretches in one batch, such as
the ends of a passage that a third of all documents hold, is hot: the batch sends one
mark for it, and the stretches of the whole bucket go down to windows that are dealt
out by their own hashes, again after settling within a batch. So neither a passage nor
its ends are a hot spot. Identifiers are hashes (anchor 38 bits and more, stretch 48,
window 64 bits); strings are not compared byte by byte.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from anchorage.llm.common import EXACT, U64, mix, prefix_sums, sliced, spans_hash
from anchorage.sources import sinks

GRAM = 14
HOT = 32  # stretches of a bucket in one batch
PART = 32 << 20  # bytes of text a part is made for
COVER, REGION, WINDOWS = 0, 1, 2  # what a span is: covered, or open within its bucket, or by windows
ENTRY = np.dtype(
    [("block", "V6"), ("bucket", "<u4"), ("doc", "<u4"), ("at", "<u4"), ("n", "u1"), ("left", "<u2"), ("right", "<u2")]
)
FIELDS = ["block", "bucket", "doc", "at", "n", "left", "right"]


def as_bytes(text):
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)


def leftmost_minima(values, width):
    """Place of the leftmost smallest value in each window of ``width``."""
    at, low, have = np.arange(len(values), dtype=np.int32), values, 1
    while have < width:
        step = min(have, width - have)
        left = low[:-step] <= low[step:]
        at = np.where(left, at[:-step], at[step:])
        low = np.where(left, low[:-step], low[step:])
        have += step
    return at


def stretches(data, length):
    """The anchors of a document: first window, number of windows, and the identifiers."""
    sums = prefix_sums(data, EXACT)
    first = np.arange(len(data) - GRAM + 1)
    grams = spans_hash(sums, first, first + GRAM)
    anchor = leftmost_minima(grams, length - GRAM + 1)
    start = np.r_[0, np.flatnonzero(np.diff(anchor)) + 1]
    n = np.diff(np.r_[start, len(anchor)])
    at = anchor[start].astype(np.int64)
    block = spans_hash(sums, start, start + n - 1 + length)
    # a window holds ``side`` bytes or more before the anchor's gram, or after it
    side = (length - GRAM) // 2
    left = spans_hash(sums, np.maximum(at - side, 0), at) >> U64(48)
    right = spans_hash(sums, at + GRAM, np.minimum(at + GRAM + side, len(data))) >> U64(48)
    left = np.where(at >= side, np.maximum(left, U64(1)), U64(0))  # 0: the text ends before
    right = np.where(at + GRAM + side <= len(data), np.maximum(right, U64(1)), U64(0))
    # a batch holds millions of these: each in the width that an entry has
    return start.astype(np.int32), n.astype(np.uint8), block, grams[at], left.astype(np.uint16), right.astype(np.uint16)


def _spans(doc, key, start, end, kind, bucket=0):
    """Spans of documents; no text keys are all 0."""
    return pd.DataFrame({"_doc": doc, "_key": 0 if key is None else key, "_from": start, "_to": end, "_kind": kind, "_bucket": bucket})


def _at(key, place):
    return None if key is None else key[place]


def _cover(doc, key, start, end):
    """Covered spans, those that overlap joined; they come sorted within each document."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > end[:-1]) | (start[1:] < start[:-1])
    if key is not None:
        new[1:] |= key[1:] != key[:-1]
    return _spans(doc[new], _at(key, new), start[new], end[np.r_[new[1:], True]] if len(doc) else end, COVER)


def _settle(block, bucket, doc):
    """Whether each entry's stretch is in a smaller document among these, in order of the entries."""
    order = np.lexsort((doc, bucket, block))
    b, k, d = block[order], bucket[order], doc[order]
    new = np.r_[True, (b[1:] != b[:-1]) | (k[1:] != k[:-1])] if len(b) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    least = d[np.flatnonzero(new)] if len(b) else d
    out = np.zeros(len(b), bool)
    out[order] = d > least[group]
    return out


def _open(block, bucket, left, right):
    """Entries whose bucket has another stretch that agrees in the gram on one side."""
    found = np.zeros(len(block), bool)
    for side in (left, right):
        some = np.flatnonzero(side)
        order = some[np.lexsort((block[some], side[some], bucket[some]))]
        b, s, e = bucket[order], side[order], block[order]
        if not len(order):
            continue
        new = np.r_[True, (b[1:] != b[:-1]) | (s[1:] != s[:-1])]
        differs = np.r_[False, (e[1:] != e[:-1]) & ~new[1:]]
        group = np.cumsum(new) - 1
        found[order[np.bincount(group, differs)[group] > 0]] = True
    return found


def _hot(block, bucket, most):
    """Entries of buckets with more than ``most`` different stretches."""
    order = np.lexsort((block, bucket))
    k, b = bucket[order], block[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    differs = np.zeros(len(k), bool)
    differs[1:] = b[1:] != b[:-1]
    group = np.cumsum(new) - 1
    out = np.zeros(len(k), bool)
    out[order] = np.bincount(group, differs | new)[group] > most if len(k) else False
    return out


def _send(rows, parts, length, hot_above=None):
    """Settle the entries of one batch; its spans, and one parcel per part.

    rows: (doc id, text key, start, n, block, bucket, left, right) arrays of each document. The
    list is emptied, so that they are not held twice.
    """
    ids, keys = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(2))
    keys = keys if keys.any() else None
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[2]) for r in rows])
    columns = list(zip(*rows))[2:]
    rows.clear()
    columns.reverse()
    at, n, block, bucket, left, right = (np.concatenate(columns.pop()) for _ in range(6))
    settled = _settle(block, bucket, ids[doc])
    spans = [_cover(ids[doc[settled]], _at(keys, doc[settled]), at[settled], at[settled] + n[settled] - 1 + length)]
    keep = np.flatnonzero(~settled)
    if hot_above is not None:
        hot = keep[_hot(block[keep], bucket[keep], hot_above)]
        if len(hot):
            spans.append(_spans(ids[doc[hot]], _at(keys, doc[hot]), at[hot], at[hot] + n[hot] - 1 + length, WINDOWS))
            marks = hot[np.unique(bucket[hot], return_index=True)[1]]
            n = n.copy()
            n[marks] = 0  # a mark
            keep = np.r_[np.setdiff1d(keep, hot, assume_unique=True), marks]
    part = (mix(bucket[keep]) % U64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    keep, part = keep[order], part[order]
    entry = np.zeros(len(keep), ENTRY)
    entry["block"] = np.ascontiguousarray(block[keep].astype("<u8").view("u1").reshape(-1, 8)[:, :6]).view("V6").ravel()
    entry["bucket"] = bucket[keep] >> U64(32)
    for name, values in (("doc", doc), ("at", at), ("n", n), ("left", left), ("right", right)):
        entry[name] = values[keep]
    cuts = np.flatnonzero(np.diff(part)) + 1
    parcels = []
    for p, e in zip(part[np.r_[0, cuts]] if len(part) else [], np.split(entry, cuts)):
        own, place = np.unique(e["doc"], return_inverse=True)
        e["doc"] = place
        data = b"".join(np.ascontiguousarray(e[f]).tobytes() for f in FIELDS)
        parcels.append((int(p), ids[own].tobytes(), _packed_keys(_at(keys, own)), data, b""))
    return pd.concat(spans), parcels


def _packed_keys(key):
    """Nothing where all keys are 0, as they are where ids are unique."""
    return b"" if key is None or not key.any() else key.tobytes()


def _keys_of(packed, places):
    """The text key at each of the places in each parcel, or none if all are 0."""
    if not any(packed):
        return None
    return np.concatenate([np.frombuffer(k, np.int64)[i] if k else np.zeros(len(i), np.int64) for k, i in zip(packed, places)])


def _receive(frames):
    """Entries of many parcels, with document ids, and their text keys."""
    columns, places = {f: [] for f in FIELDS}, []
    for ids, _, data in frames:
        ids, n, at = np.frombuffer(ids, np.int64), len(data) // ENTRY.itemsize, 0
        for f in FIELDS:
            kind = ENTRY[f]
            column = np.frombuffer(data, kind, n, at)
            at += n * kind.itemsize
            columns[f].append(ids[column] if f == "doc" else column)
            if f == "doc":
                places.append(column)
    key = _keys_of([k for _, k, _ in frames], places)
    out = {f: np.concatenate(c) for f, c in columns.items()}
    wide = np.zeros((len(out["block"]), 8), "u1")
    wide[:, :6] = out["block"].view("u1").reshape(-1, 6)
    out["block"] = wide.view("<u8").ravel()
    return out, key


SPAN = "_doc long, _key long, _from long, _to long, _kind int, _bucket long"
SPAN_NAMES = ["_doc", "_key", "_from", "_to", "_kind", "_bucket"]
PARCEL = f"_part int, _ids binary, _keys binary, _data binary, _raw binary, {SPAN}"
PARCEL_NAMES = ["_part", "_ids", "_keys", "_data", "_raw", *SPAN_NAMES]


def _out(spans, parcels):
    if parcels:
        # not null: pandas would read the numbers of spans beside them as floats, which hold 53 bits
        yield pd.DataFrame([(*p, *[0] * len(SPAN_NAMES)) for p in parcels], columns=PARCEL_NAMES)
    if len(spans):  # dealt out too, but nothing is done with them there
        yield spans.assign(_part=spans["_doc"] % 1009, _ids=None, _keys=None, _data=None, _raw=None)[PARCEL_NAMES]


def _first(length, parts, hot):
    def run(batches):
        for batch in batches:
            rows = []
            for i, key, text in zip(batch["_doc"], batch["_key"], batch["_text"]):
                data = as_bytes(text)
                if len(data) >= length:
                    rows.append((i, key, *stretches(data, length)))
            if rows:
                yield from _out(*_send(rows, parts, length, hot))

    return run


def _windows(length, parts):
    """Windows of hot buckets: each is a stretch of one, in a bucket of its own."""

    def run(batches):
        for batch in batches:
            rows = []
            for i, key, text, spans in zip(batch["_doc"], batch["_key"], batch["_text"], batch["_spans"]):
                spans = [s for s in spans if s["_kind"] == WINDOWS]
                if spans:
                    at = np.concatenate([np.arange(s["_from"], s["_to"] - length + 1) for s in spans])
                    window = spans_hash(prefix_sums(as_bytes(text), EXACT), at, at + length)
                    none = np.zeros(len(at), U64)
                    rows.append((i, key, at, np.ones(len(at), np.int64), window, mix(window), none, none))
            if rows:
                yield from _out(*_send(rows, parts, length))

    return run


HEAD = np.dtype([("bucket", "<u4"), ("doc", "<u4"), ("at", "<u4"), ("size", "u1")])


def _regions(parts):
    """The bytes of open stretches, dealt out by bucket."""

    def run(batches):
        for batch in batches:
            found = {}
            for i, key, text, spans in zip(batch["_doc"], batch["_key"], batch["_text"], batch["_spans"]):
                spans = [s for s in spans if s["_kind"] == REGION]
                data = as_bytes(text).tobytes() if spans else b""
                for s in spans:
                    heads, ids, keys, raw = found.setdefault(s["_bucket"] % parts, ([], [], [], []))
                    heads.append((s["_bucket"], len(ids), s["_from"], s["_to"] - s["_from"]))
                    ids.append(i)
                    keys.append(key)
                    raw.append(data[s["_from"] : s["_to"]])
            parcels = [
                (p, np.array(ids, np.int64).tobytes(), _packed_keys(np.array(keys, np.int64)), np.array(heads, HEAD).tobytes(), b"".join(raw))
                for p, (heads, ids, keys, raw) in found.items()
            ]
            yield from _out(_spans([], [], [], [], COVER), parcels)

    return run


def _dealt(parcels):
    """The parcels of a part together and in a row; a bucket lies in one part, so a part is met by itself."""
    return parcels.repartition("_part").sortWithinPartitions("_part")


def _arriving(batches, kept):
    """(spans, None) of what is settled, and (None, parcels) of one part at a time."""
    part, held = None, []
    for batch in batches:
        done = batch["_data"].isna()
        if done.any():
            yield batch.loc[done, SPAN_NAMES], None
        batch = batch[~done]
        for p, *parcel in zip(batch["_part"], *(batch[c] for c in kept)):
            if p != part and held:
                yield None, held
                held = []
            part = p
            held.append(parcel)
    if held:
        yield None, held


def _meet(length):
    """All entries of a part: which are settled, and which stay open."""

    def run(batches):
        for spans, parcels in _arriving(batches, ("_ids", "_keys", "_data")):
            if parcels is None:
                yield spans
            else:
                yield from meet(parcels)

    def meet(parcels):
        e, key = _receive(parcels)
        mark = e["n"] == 0
        hot = np.isin(e["bucket"], np.unique(e["bucket"][mark]))
        e = {f: v[~mark] for f, v in e.items()}
        hot, key = hot[~mark], _at(key, ~mark)
        settled = _settle(e["block"], e["bucket"], e["doc"])
        rest = np.flatnonzero(~settled & ~hot)
        rest = rest[_open(e["block"][rest], e["bucket"][rest], e["left"][rest], e["right"][rest])]
        for found, kind in ((settled, COVER), (rest, REGION), (~settled & hot, WINDOWS)):
            at = e["at"][found].astype(np.int64)
            end = at + e["n"][found] - 1 + length
            yield _spans(e["doc"][found], _at(key, found), at, end, kind, e["bucket"][found].astype(np.int64))

    return run


def _meet_regions(length):
    """All windows of the regions of a bucket against each other, some buckets at a time."""

    def run(batches):
        for spans, parcels in _arriving(batches, ("_ids", "_keys", "_data", "_raw")):
            if parcels is None:
                yield spans
            else:
                yield from meet(parcels)

    def meet(parcels):
        heads, docs, packed, raws = [], [], [], []
        for i, k, data, raw in parcels:
            head = np.frombuffer(data, HEAD)
            heads.append(head)
            docs.append(np.frombuffer(i, np.int64)[head["doc"]])
            packed.append(k)
            raws.append(np.frombuffer(raw, np.uint8))
        key = _keys_of(packed, [h["doc"] for h in heads])
        head, doc, raw = np.concatenate(heads), np.concatenate(docs), np.concatenate(raws)
        size = head["size"].astype(np.int64)
        begin = np.cumsum(size) - size
        order = np.argsort(head["bucket"], kind="stable")
        bucket = head["bucket"][order]
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        cuts = [*np.unique(edges // (1 << 16), return_index=True)[1], len(edges)]
        edges = np.r_[edges, len(order)]
        for a, b in zip(cuts, cuts[1:]):
            some = order[edges[a] : edges[b]]
            n, long = size[some] - length + 1, size[some]
            data = raw[np.repeat(begin[some] - (np.cumsum(long) - long), long) + np.arange(long.sum())]
            own = np.repeat(np.arange(len(some)), n)
            inside = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            at = (np.cumsum(long) - long)[own] + inside
            window = spans_hash(prefix_sums(data, EXACT), at, at + length)
            settled = _settle(window, head["bucket"][some][own], doc[some][own])
            place = (head["at"][some].astype(np.int64)[own] + inside)[settled]
            yield _cover(doc[some][own][settled], _at(_at(key, some), own[settled]), place, place + length)

    return run


def merged(starts, ends):
    """Sorted, disjoint and not touching runs of the union of [start, end)."""
    order = np.argsort(starts, kind="stable")
    s, e = np.asarray(starts)[order], np.maximum.accumulate(np.asarray(ends)[order])
    new = np.r_[True, s[1:] > e[:-1]]
    return s[new], e[np.r_[new[1:], True]]


def _cut(batches):
    for batch in sliced(batches):
        rows = []
        for text, starts, ends in zip(batch["_text"], batch["_starts"], batch["_ends"]):
            data = as_bytes(text)
            if starts is None or not len(starts):
                s = e = np.zeros(0, np.int64)
            else:
                s, e = merged(starts, ends)
            edges = np.zeros(len(data) + 1, np.int64)
            np.add.at(edges, s, 1)
            np.add.at(edges, e, -1)
            kept = data[np.cumsum(edges[:-1]) == 0].tobytes()
            rows.append((len(data), len(data) - len(kept), s.tolist(), e.tolist(), hashlib.sha256(kept).hexdigest(), kept, kept.decode("utf-8", "ignore")))
        out = batch.drop(columns=["_text", "_starts", "_ends", "_doc", "_key"])
        names = ["n_bytes", "n_removed", "starts", "ends", "kept_sha256", "kept", "kept_text"]
        yield out.assign(**{n: [r[i] for r in rows] for i, n in enumerate(names)})


def _keyed(texts):
    """Rows (_doc, _text) with ``_key``: a hash of the text where an id has several texts, else 0."""
    key = F.xxhash64("_text")
    several = sinks.materialize(
        texts.where("_doc is not null").groupBy("_doc").agg(F.min(key).alias("a"), F.max(key).alias("b")).where("a < b").select("_doc")
    )
    if several.isEmpty():
        return texts.withColumn("_key", F.lit(0).cast("long"))
    found = texts.join(several.withColumn("_several", F.lit(True)), "_doc", "left")
    return found.withColumn("_key", F.when(F.col("_several"), key).otherwise(F.lit(0).cast("long"))).drop("_several")


def dedup(docs, length=50, id_col="doc_id", text_col="text", keep=(), hot=HOT):
    """What is left of every text without the bytes that repeat an earlier document.

    Texts are UTF-8 bytes. A byte goes if a ``length``-byte string over it also starts in a
    document with a smaller id; strings are those of the input. Returns the id, the
    columns named in ``keep``, n_bytes, n_removed, ``starts`` and ``ends`` of the removed
    runs, kept_sha256, ``kept`` (bytes; cuts may fall inside a character) and ``kept_text``
    (without characters that a cut went through).

    A null text counts as empty. A text under ``length`` bytes loses nothing. Ids are
    integers; a row without one loses nothing and takes nothing from others. Rows of
    one id are one document, whatever their texts: they take nothing from each other.
    One row per row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // PART)
    extra = [c for c in keep if c not in (id_col, text_col)]
    texts = _keyed(docs.select(F.col(id_col), F.col(id_col).cast("long").alias("_doc"), text.alias("_text"), *extra))
    some = texts.select("_doc", "_key", "_text").where(F.col("_doc").isNotNull() & (F.octet_length("_text") >= length))
    met = sinks.materialize(
        _dealt(some.mapInPandas(_first(length, parts, hot), PARCEL)).mapInPandas(_meet(length), SPAN)
    )
    opened = (
        met.where(F.col("_kind") != COVER)
        .groupBy("_doc", "_key")
        .agg(F.array_sort(F.collect_list(F.struct("_from", "_to", "_kind", "_bucket"))).alias("_spans"))
    )
    opened = some.join(opened, ["_doc", "_key"])
    windows = _dealt(opened.mapInPandas(_windows(length, parts), PARCEL)).mapInPandas(_meet(length), SPAN)
    regions = _dealt(opened.mapInPandas(_regions(parts), PARCEL)).mapInPandas(_meet_regions(length), SPAN)
    covered = (
        met.union(windows)
        .where(F.col("_kind") == COVER)
        .union(regions)
        .groupBy("_doc", "_key")
        .agg(F.array_sort(F.collect_list(F.struct("_from", "_to"))).alias("_s"))
        .select("_doc", "_key", F.col("_s._from").alias("_starts"), F.col("_s._to").alias("_ends"))
    )
    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts.join(covered, ["_doc", "_key"], "left")
    schema = ", ".join(
        [f"`{id_col}` {kind}", *(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in extra)]
        + ["n_bytes long, n_removed long, starts array<long>, ends array<long>, kept_sha256 string, kept binary, kept_text string"]
    )
    return rows.mapInPandas(_cut, schema)
