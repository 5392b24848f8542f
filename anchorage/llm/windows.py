"""Substring dedup over word windows, with a count-min prefilter.

A window is ``length`` consecutive words. Its anchor is the place of the smallest hash among
its ``GRAM``-word grams, so equal windows have equal anchors at equal places, and a window
is there at most as often as its anchor's gram. The windows that share an anchor form a
stretch, which is the unit of everything below.

First pass: each batch of documents makes a sparse count-min sketch of its anchors. The
cells are cut into slices, as many as the input needs, and the slices of all batches are
merged, each by itself: nothing is broadcast, and the sketch is as wide at every size of
input. A merged slice tells the documents which of their anchors it estimates to be there
twice or more. Estimates are never too low, so no repeated window is lost.

Second pass: only stretches of such anchors are hashed window by window. A batch settles
among its own, and sends what is left to be grouped exactly, by anchor and window hash
(128 bits together). Anchors that are estimated to be very frequent, such as those at the
ends of a passage that a third of all documents hold, are few, and are known to all
tasks; their windows are dealt out one by one.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from anchorage.llm.common import BASE, EXACT, U64, mix, sorted_groups
from anchorage.llm.suffixes import _keyed as keyed
from anchorage.llm.suffixes import leftmost_minima, merged
from anchorage.sources import sinks

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
CODES = np.where(SPACE, U64(0), EXACT)
STEP = 1 << 12
LOW = np.cumprod(np.r_[U64(1), np.full(STEP - 1, BASE, U64)], dtype=U64)
HIGH = U64(pow(BASE, STEP, 1 << 64))
OTHER = U64(0xD6E8FEB86659FD93)  # an odd multiplier for windows, as BASE is for grams

GRAM = 0.4  # of a window's words
SLICE = 1 << 20  # anchors of a slice, on average
WIDTH = 22  # bits of a row's cells in a slice; there are two rows
PART = 1 << 20  # windows in a part of the second pass, were all of them there
CROWDED, MOST_CROWDS = 256, 1 << 16  # a frequent anchor has so many places at least; so many there are at most
BLOCK = 1 << 22  # bytes hashed at a time
SPREAD = 1 << 20  # what needs no grouping is dealt out by so many values of the id


def _block_words(data):
    """Starts and hashes of the words of a piece of text that no word reaches beyond."""
    space = SPACE[data]
    start = np.flatnonzero(~space & np.r_[True, space[:-1]])
    if not len(start):
        return start, np.zeros(0, U64)
    first = start[0]
    inside = np.arange(first, len(data)) - np.repeat(start, np.diff(np.r_[start, len(data)]))
    value = CODES[data[first:]] * LOW[inside & (STEP - 1)]
    most = int(inside.max()) // STEP
    if most:  # a very long word, or white space
        value *= np.cumprod(np.r_[U64(1), np.full(most, HIGH, U64)], dtype=U64)[inside // STEP]
    return start, mix(np.add.reduceat(value, start - first))


def words_of(data):
    """Starts and hashes of the words of UTF-8 bytes; memory for one block at a time beside them."""
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data):  # on to the next white space
            space = SPACE[data[end : end + STEP]]
            if space.any():
                end += int(space.argmax())
                break
            end += len(space)
        s, h = _block_words(data[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    return np.concatenate(starts), np.concatenate(hashes)


def rolled(words, n, factor):
    """Hashes of all ``n`` consecutive words."""
    out = np.zeros(max(len(words) - n + 1, 0), U64)
    for k in range(n):
        out *= U64(factor)
        out += words[k : len(words) - n + 1 + k]
    return mix(out)


class Texts:
    """The stretches of some texts: text, first window (in words of the text), number of windows, anchor's gram."""

    def __init__(self, texts, length):
        gram = max(1, int(GRAM * length))
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        begin = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
        at, self.words = words_of(np.frombuffer(b"\n".join(parts), np.uint8))
        self.length = length
        text = np.searchsorted(begin, at, "right") - 1
        self.text, self.first, self.n, self.gram = (np.zeros(0, np.int64) for _ in range(4))
        self.gram = self.gram.view(U64)
        if len(at) < length:
            return
        valid = np.flatnonzero(text[: len(at) - length + 1] == text[length - 1 :])
        if not len(valid):
            return
        grams = rolled(self.words, gram, BASE)
        anchor = leftmost_minima(grams, length - gram + 1)[valid]
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)])
        self.place = valid[new]  # of the first window among all words
        self.n = np.diff(np.r_[new, len(valid)])
        self.text = text[self.place]
        self.first = self.place - np.searchsorted(at, begin)[self.text]
        self.gram = grams[anchor[new]]

    def windows(self, some):
        """Of the given stretches: each window's stretch, place in its text, and hash."""
        n = self.n[some]
        own = np.repeat(some, n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = self.place[own] + step
        out = np.zeros(len(own), U64)
        for k in range(self.length):
            out *= OTHER
            out += self.words[place + k]
        return own, self.first[own] + step, mix(out)


def portions(batch, most=1 << 25):
    """A batch in frames of about ``most`` characters of text."""
    size = np.cumsum(batch["_text"].str.len().to_numpy()) // most
    for _, part in batch.groupby(size, sort=False):
        yield part.reset_index(drop=True)


def cut(values, by):
    """(value of ``by``, indexes) for each of its values."""
    order = np.argsort(by, kind="stable")
    edges = np.flatnonzero(np.diff(by[order])) + 1
    return zip(by[order[np.r_[0, edges]]] if len(order) else [], np.split(values[order], edges))


# --- first pass


def cell(gram, slices):
    """Slice and cell number of an anchor's gram."""
    return ((gram >> U64(32)) % U64(slices)).astype(np.int64), gram.astype(np.uint32)


HOT = "_doc long, _key long, _hot binary"
SKETCH = f"_slice int, _docs binary, _keys binary, _cells binary, _many binary, _counts binary, {HOT}"


# numbers are never null where frames of both kinds mix: pandas would read them as floats
NO_SLICE, NO_TEXT = -1, (0, 0, None)
HOT_NAMES = ["_doc", "_key", "_hot"]
SKETCH_NAMES = ["_slice", "_docs", "_keys", "_cells", "_many", "_counts", "_doc", "_key", "_hot"]


def _sketches(length, slices):
    """Sparse sketches of batches by slice; what a batch holds twice is known to be repeated at once."""

    def run(batches):
        for batch in batches:
            for rows in portions(batch):
                found = Texts(rows["_text"], length)
                docs, keys = (rows[c].to_numpy(np.int64) for c in ("_doc", "_key"))
                gram, place, count = np.unique(found.gram, return_inverse=True, return_counts=True)
                out = []
                twice = count[place] > 1
                for text, cells in cut(found.gram[twice].astype(np.uint32), found.text[twice]):
                    out.append((NO_SLICE, None, None, None, None, None, docs[text], keys[text], np.unique(cells).tobytes()))
                once, text = found.gram[~twice], found.text[~twice]
                at, cells = cell(once, slices)
                alone = dict(cut(np.arange(len(once)), at))
                many = count > 1
                many_at, many_cells = cell(gram[many], slices)
                together = dict(cut(np.arange(len(many_at)), many_at))
                for s in alone.keys() | together.keys():
                    a, t = alone.get(s, np.zeros(0, int)), together.get(s, np.zeros(0, int))
                    some = docs[text[a]], keys[text[a]], cells[a], many_cells[t], count[many][t].astype(np.uint32)
                    own = [x.tobytes() if x.any() else b"" for x in some[1:2]]
                    out.append((s, some[0].tobytes(), *own, *(x.tobytes() for x in some[2:]), *NO_TEXT))
                yield pd.DataFrame(out, columns=SKETCH_NAMES).assign(_deal=[r[6] % SPREAD if r[0] == NO_SLICE else r[0] for r in out])

    return run


def rows_of_cell(cells):
    """A cell's counter in each of the two rows."""
    return (cells & np.uint32((1 << WIDTH) - 1)).astype(np.int64), ((cells * np.uint32(0x9E3779B1)) >> np.uint32(32 - WIDTH)).astype(np.int64)


def estimates(parcels):
    """Counts of each parcel's cells in the merged sketch of a slice: (cells, counts) arrays."""
    counters = [np.zeros(1 << WIDTH, np.int64) for _ in range(2)]
    for cells, counts in parcels:
        for row, at in zip(counters, rows_of_cell(cells)):
            np.add.at(row, at, counts)
    return [np.minimum(*(row[at] for row, at in zip(counters, rows_of_cell(cells)))) for cells, _ in parcels]


def _merged(crowded):
    """The documents' repeated anchors by slice, and the frequent ones (without a document)."""

    def run(batches):
        def slices():
            for batch in batches:
                done = batch["_slice"] == NO_SLICE
                if done.any():
                    passed.append(batch.loc[done, HOT_NAMES].assign(_crowd=None))
                yield batch[~done]

        passed = []
        for group in sorted_groups(slices(), ["_slice"]):
            yield from passed
            passed.clear()
            s = int(group["_slice"].iloc[0])
            alone = [np.frombuffer(x, np.uint32) for x in group["_cells"]]
            many = [(np.frombuffer(m, np.uint32), np.frombuffer(c, np.uint32)) for m, c in zip(group["_many"], group["_counts"])]
            found = estimates([*((x, np.ones(len(x), np.int64)) for x in alone), *many])
            docs = np.concatenate([np.frombuffer(x, np.int64) for x in group["_docs"]])
            keys = np.concatenate([np.frombuffer(k, np.int64) if k else np.zeros(len(x), np.int64) for k, x in zip(group["_keys"], alone)])
            cells, count = np.concatenate(alone), np.concatenate(found[: len(alone)])
            crowd = np.unique(np.concatenate([np.r_[x[n >= crowded]] for x, n in zip([*alone, *(m for m, _ in many)], found)]))
            if len(crowd):
                yield pd.DataFrame({"_crowd": (s << 32) + crowd.astype(np.int64)}).assign(**{c: None for c in HOT_NAMES})
            hot = np.flatnonzero(count > 1)
            hot = hot[np.lexsort((keys[hot], docs[hot]))]
            edges = np.flatnonzero((np.diff(docs[hot]) != 0) | (np.diff(keys[hot]) != 0)) + 1
            heads = hot[np.r_[0, edges]] if len(hot) else hot
            if len(hot):
                found = [c.tobytes() for c in np.split(cells[hot], edges)]
                yield pd.DataFrame({"_doc": docs[heads], "_key": keys[heads], "_hot": found}).assign(_crowd=None)
        yield from passed

    return run


# --- second pass

PARCEL = "_part int, _ids binary, _keys binary, _own binary, _at binary, _n binary, _grams binary, _windows binary"
SPAN = "_doc long, _key long, _from long, _to long"
PARCEL_NAMES = ["_part", "_ids", "_keys", "_own", "_at", "_n", "_grams", "_windows"]
SPAN_NAMES = ["_doc", "_key", "_from", "_to"]


def settle(gram, window, doc, at):
    """Whether each window is at an earlier place too, among these: in a smaller document, or before in the same."""
    order = np.lexsort((window, gram))
    g, w, d, a = gram[order], window[order], doc[order], at[order]
    out = np.zeros(len(order), bool)
    if not len(order):
        return out
    new = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (w[1:] != w[:-1])])
    size = np.diff(np.r_[new, len(order)])
    least = np.repeat(np.minimum.reduceat(d, new), size)
    first = np.repeat(np.minimum.reduceat(np.where(d == least, a, np.iinfo(np.int64).max), new), size)
    out[order] = (d > least) | (a > first)
    return out


def _runs(own, at):
    """Begins of runs of consecutive places in the same text or stretch."""
    return np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)]) if len(own) else np.zeros(0, np.int64)


def _spans(docs, keys, own, at, length):
    """Covered spans in words of windows that lie in order of text and place."""
    new = _runs(own, at)
    last = np.r_[new[1:], len(own)] - 1 if len(own) else new
    return pd.DataFrame({"_doc": docs[own[new]], "_key": keys[own[new]], "_from": at[new], "_to": at[last] + length})


def _candidates(length, slices, parts, crowds):
    def run(batches):
        known = np.sort(crowds.value)
        for batch in batches:
            for rows in portions(batch):
                found = Texts(rows["_text"], length)
                docs, keys = (rows[c].to_numpy(np.int64) for c in ("_doc", "_key"))
                hot = [np.frombuffer(b"".join(x), np.uint32) for x in rows["_hot"]]
                hot = np.unique(np.concatenate([(U64(i) << U64(32)) + h.astype(U64) for i, h in enumerate(hot)]))
                at, cells = cell(found.gram, slices)
                wanted = (found.text.astype(U64) << U64(32)) + cells.astype(U64)
                some = np.flatnonzero(np.isin(wanted, hot, kind="sort"))
                stretch, place, window = found.windows(some)
                text, gram = found.text[stretch], found.gram[stretch]
                covered = settle(gram, window, docs[text], place)
                spans = _spans(docs, keys, text[covered], place[covered], length)
                if len(spans):
                    yield spans.assign(**{c: None for c in PARCEL_NAMES[1:]}, _part=NO_SLICE, _deal=spans["_doc"] % SPREAD)
                rest = np.flatnonzero(~covered)
                stretch, place, window, text, gram = (x[rest] for x in (stretch, place, window, text, gram))
                crowd = np.isin((at[stretch] << 32) + cells[stretch].astype(np.int64), known)
                part = (mix(np.where(crowd, window, gram)) % U64(parts)).astype(np.int64)
                new = np.zeros(len(rest), bool)
                new[_runs(stretch, place)] = True
                new |= crowd
                new = np.flatnonzero(new)
                n = np.diff(np.r_[new, len(rest)])
                out = []
                for p, k in cut(np.arange(len(new)), part[new]):
                    ids, own = np.unique(text[new[k]], return_inverse=True)
                    inside = np.repeat(new[k], n[k]) + np.arange(n[k].sum()) - np.repeat(np.cumsum(n[k]) - n[k], n[k])
                    key = keys[ids]
                    out.append(
                        (
                            p,
                            docs[ids].tobytes(),
                            key.tobytes() if key.any() else b"",
                            own.astype("<u4").tobytes(),
                            place[new[k]].astype("<u4").tobytes(),
                            n[k].astype("<u2").tobytes(),
                            gram[new[k]].tobytes(),
                            window[inside].tobytes(),
                        )
                    )
                yield pd.DataFrame(out, columns=PARCEL_NAMES).assign(**{c: 0 for c in SPAN_NAMES}, _deal=[r[0] for r in out])

    return run


def _grouped(length):
    """Windows of a part against each other, one part at a time."""

    def run(batches):
        def parcels():
            for batch in batches:
                done = batch["_part"] == NO_SLICE
                if done.any():
                    passed.append(batch.loc[done, SPAN_NAMES])
                yield batch[~done]

        passed = []
        for group in sorted_groups(parcels(), ["_part"]):
            yield from passed
            passed.clear()
            docs, keys, own, at, n, gram, window = [], [], [], [], [], [], []
            begin = 0
            for r in group[PARCEL_NAMES[1:]].itertuples(index=False):
                ids = np.frombuffer(r[0], np.int64)
                docs.append(ids)
                keys.append(np.frombuffer(r[1], np.int64) if r[1] else np.zeros(len(ids), np.int64))
                own.append(np.frombuffer(r[2], "<u4").astype(np.int64) + begin)
                at.append(np.frombuffer(r[3], "<u4").astype(np.int64))
                n.append(np.frombuffer(r[4], "<u2").astype(np.int64))
                gram.append(np.frombuffer(r[5], U64))
                window.append(np.frombuffer(r[6], U64))
                begin += len(ids)
            docs, keys, own, at, n, gram, window = map(np.concatenate, (docs, keys, own, at, n, gram, window))
            place = np.repeat(at, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            text = np.repeat(own, n)
            covered = settle(np.repeat(gram, n), window, docs[text], place)
            yield _spans(docs, keys, text[covered], place[covered], length)
        yield from passed

    return run


def _kept(batches):
    for batch in batches:
        rows = []
        for text, starts, ends in zip(batch["_text"], batch["_starts"], batch["_ends"]):
            words = text.encode("utf-8", "surrogatepass").split()  # of bytes: at ASCII white space alone
            n, removed = len(words), 0
            s = e = np.zeros(0, np.int64)
            if starts is not None and len(starts):
                s, e = merged(starts, ends)
                removed = int((e - s).sum())
                edges = [0, *np.c_[s, e].ravel().tolist(), n]
                words = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
            kept = b" ".join(words)
            rows.append((n, removed, s.tolist(), e.tolist(), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
        out = batch.drop(columns=["_text", "_starts", "_ends", "_doc", "_key"])
        names = ["n_words", "n_removed", "starts", "ends", "kept_sha256", "kept_text"]
        yield out.assign(**{c: [r[i] for r in rows] for i, c in enumerate(names)})


def dedup(docs, length=20, id_col="doc_id", text_col="text"):
    """What is left of every text without the words of windows that are there earlier.

    Words are runs of anything but ASCII white space. A word goes if a window of ``length``
    words over it also starts earlier: in a document with a smaller id, or before in the
    same one. Windows are those of the input. Returns the id, n_words, n_removed, ``starts``
    and ``ends`` of the removed runs in words, kept_sha256 and ``kept_text`` (the kept words
    with single spaces).

    A null text has no words; one under ``length`` words loses nothing. Ids are integers; a
    row without one loses nothing and takes nothing from others. Rows of one id are one
    document: of two places that are equal in id and start neither is earlier. One row per
    row, repeated ones too; other columns are left out.
    """
    spark = docs.sparkSession
    # pandas would read ids beside a null one as floats
    texts = keyed(docs.select(F.col(id_col).cast("string").alias("_id"), F.col(id_col).cast("long").alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")))
    some = texts.select("_doc", "_key", "_text").where(F.col("_doc").isNotNull() & (F.octet_length("_text") >= 2 * length - 1))
    # a window begins with a word, and an anchor has several windows
    words = int((some.agg(F.sum(F.octet_length("_text"))).first()[0] or 0) / 6) + 1
    anchors = -(-2 * words // (length - int(GRAM * length) + 2))
    slices, parts = -(-anchors // SLICE), max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // PART))
    crowded = max(CROWDED, -(-anchors // MOST_CROWDS))
    told = sinks.materialize(
        some.mapInPandas(_sketches(length, slices), f"{SKETCH}, _deal int")
        .repartition("_deal")
        .sortWithinPartitions("_slice")
        .mapInPandas(_merged(crowded), f"{HOT}, _crowd long")
    )
    crowds = told.where("_crowd is not null").select("_crowd").distinct().toPandas()["_crowd"].to_numpy(np.int64)
    crowds = spark.sparkContext.broadcast(crowds)  # a few for each MOST_CROWDS, as counts add up to the anchors
    hot = told.where("_doc is not null").groupBy("_doc", "_key").agg(F.collect_list("_hot").alias("_hot"))
    spans = (
        some.join(hot, ["_doc", "_key"])
        .mapInPandas(_candidates(length, slices, parts, crowds), f"{PARCEL}, {SPAN}, _deal int")
        .repartition("_deal")
        .sortWithinPartitions("_part")
        .mapInPandas(_grouped(length), SPAN)
    )
    covered = (
        spans.groupBy("_doc", "_key")
        .agg(F.collect_list(F.struct("_from", "_to")).alias("_s"))
        .select("_doc", "_key", F.col("_s._from").alias("_starts"), F.col("_s._to").alias("_ends"))
    )
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_id string, n_words long, n_removed long, starts array<long>, ends array<long>, kept_sha256 string, kept_text string"
    found = texts.join(covered, ["_doc", "_key"], "left").mapInPandas(_kept, schema)
    return found.select(F.col("_id").cast(kind).alias(id_col), *found.columns[1:])
