"""SentencePiece encoding and decoding, with giant texts in parallel by a max-plus scan.

The segmentation is a path through the text: a piece may follow another if the merges
leave the joint of the two alone, and a path's weight is the sum of its pieces' scores, or
minus infinity. A giant text is cut into chunks at any place. A chunk's transfer matrix
has the best weight from each state at its left cut to each at its right cut; a state is
the piece that ends at or reaches over the cut, and how far. Matrices combine by max
and plus, in any grouping; their product fixes the state at each cut, and each chunk then
traces its own pieces back. For byte-pair models just one path is not infinite, and it
is the library's encoding.
"""

import re
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from anchorage.llm.bpe import REMEMBERED, SHORT, Bpe
from anchorage.llm.common import TOGETHER, Ids, sliced
from anchorage.llm.lattice import Lattice
from anchorage.sources import sinks

CHUNK = 1 << 16  # code points
SPACE = "▁"
START = ("", 0)


class Pieces:
    """A byte-pair SentencePiece model."""

    def __init__(self, path):
        import sentencepiece

        self.path = path
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        sp, n = self.sp, self.sp.vocab_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id = {sp.id_to_piece(i): i for i in plain}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.scores = np.array([self.score.get(sp.id_to_piece(i), 0.0) for i in range(n)])
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        order = {p: -s for p, s in self.score.items()}
        self.bpe = Bpe(lambda a, b: order.get(a + b), set(self.id))
        self.longest = self.bpe.longest
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a piece has a blank inside; units of this model are not independent")
        # characters that no piece has side by side never merge, so a unit ends between them
        pairs = {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}
        place = {c: i for i, c in enumerate(sorted(set("".join(pairs))), 1)}
        self.code = np.zeros(0x110000, np.int32)
        self.code[[ord(c) for c in place]] = list(place.values())
        self.apart = np.ones((len(place) + 1,) * 2, bool)
        for a, b in pairs:
            self.apart[place[a], place[b]] = False
        self.lattice = Lattice(self.bpe)
        self.number = np.array([self.id[p] for p in self.lattice.names], np.int64)
        self.cache = Ids(self.learn, REMEMBERED // 4)

    def normal(self, text):
        return self.sp.normalize(text)

    def units(self, text):
        """The text in pieces of text that no merge reaches across."""
        if not text:
            return []
        code = self.code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        cuts = (np.flatnonzero(self.apart.ravel()[code[:-1] * len(self.apart) + code[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]

    def ids(self, pieces):
        out = []
        for p in pieces:
            known = self.id.get(p)
            if known is not None:
                out.append(known)
            elif self.byte:
                out += [self.byte[b] for b in p.encode("utf-8", "surrogatepass")]
            else:
                out.append(self.sp.unk_id())
        return out

    def weight(self, pieces):
        return float(sum(self.score.get(p, 0.0) for p in pieces))

    def follows(self, last, piece):
        if not last or (piece.startswith(SPACE) and not last.endswith(SPACE)):
            return True
        return self.bpe.whole(piece) and self.bpe.stays(last, piece)

    def known(self, piece):
        return len(piece) == 1 or piece in self.id

    def walk(self, text, last):
        """For each place the piece that ends there, after a piece ``last`` before the text."""
        if not last:
            begins = self.bpe.path(text)[0]
            return [last, *(text[b:i] if b >= 0 else None for i, b in enumerate(begins[1:], 1))]
        at = [last, *[None] * len(text)]
        for end in range(1, len(text) + 1):
            for begin in range(max(0, end - self.longest), end):
                piece = text[begin:end]
                if at[begin] is not None and self.known(piece) and self.follows(at[begin], piece):
                    at[end] = piece
                    break
        return at

    def unit(self, text):
        """The pieces of a unit from its start."""
        return self.bpe.tokenized(text)

    def trace(self, text, state):
        """The pieces of a text after a state, up to its end; None if no path gets there."""
        if state == START:
            return [p for u in self.units(text) for p in self.unit(u)]
        last, over = state
        at, end, out = self.walk(text[over:], last), len(text) - over, []
        if end < 0 or at[end] is None:
            return None
        while end:
            out.append(at[end])
            end -= len(at[end])
        return out[::-1]

    def learn(self, units):
        """Ids of the pieces of each unit: short ones together, long ones alone."""
        short = [u for u in units if len(u) <= SHORT]
        token, size = self.lattice.paths(short)
        ids = np.append(self.number, 0)[np.minimum(token, len(self.number))].tolist()
        ends = np.cumsum(np.r_[0, size]).tolist()
        rows = [ids[a:b] for a, b in zip(ends, ends[1:])]
        lone = np.flatnonzero(token >= len(self.number))
        for k in np.unique(np.searchsorted(ends, lone, "right") - 1).tolist():  # characters that are no piece
            rows[k] = self.ids(map(self.lattice.name, token[ends[k] : ends[k + 1]].tolist()))
        if len(short) == len(units):
            return rows
        rows = iter(rows)
        return [next(rows) if len(u) <= SHORT else self.ids(self.unit(u)) for u in units]

    # --- chunks

    def states(self, before, after):
        """All states at a cut between two strings: pieces that end at it or reach over it."""
        if after.startswith(SPACE) and not before.endswith(SPACE):
            return [START]  # a unit ends here, and what is before does not matter
        found = []
        for reach in range(min(self.longest, len(after) + 1)):
            for own in range(1, min(self.longest - reach, len(before)) + 1):
                piece = before[len(before) - own :] + after[:reach]
                if self.known(piece) and self.bpe.whole(piece):
                    found.append((piece, reach))
        return found

    def edges(self, text):
        """Ends of the first and begin of the last unit that lie inside a chunk, or None."""
        found = [m.start() for m in re.finditer(f"(?<!{SPACE}){SPACE}", text) if m.start()]
        return (found[0], found[-1]) if found else None

    def into(self, text, state, out):
        """Pieces from a state at the left of a text to a state at its right; None if no path."""
        piece, reach = out
        own = len(piece) - reach
        if out == START:
            return self.trace(text, state)
        head = len(text) - own
        if head < state[1]:  # a piece that covers the whole chunk is the same state on both sides
            return [] if (state[0], state[1] - len(text)) == out and state[1] >= len(text) else None
        before = self.trace(text[:head], state)
        if before is None or not self.follows(before[-1] if before else state[0], piece):
            return None
        return [*before, piece]

    def matrix(self, left, text, right):
        """(state in, state out, weight) of every path through a chunk."""
        ins = self.states(left, text + right) if left else [START]
        outs = self.states(left + text, right) if right else [START]
        edges = self.edges(text)
        found = []
        if edges is None:
            for a in ins:
                for b in outs:
                    path = self.into(text, a, b)
                    if path is not None:
                        found.append((a, b, self.weight(path)))
            return found
        first, last = edges
        heads = [(a, self.trace(text[:first], a)) for a in ins]
        tails = [(b, self.into(text[last:], START, b)) for b in outs]
        middle = float(self.scores[self.cache.of(self.units(text[first:last]))].sum())
        for a, head in heads:
            for b, tail in tails:
                if head is not None and tail is not None:
                    found.append((a, b, self.weight(head) + middle + self.weight(tail)))
        return found

    def chunk_ids(self, text, state, out):
        """Ids of the pieces that begin in a chunk."""
        edges = self.edges(text)
        if edges is None:
            return np.array(self.ids(self.into(text, state, out)), np.uint32)
        first, last = edges
        head = self.ids(self.trace(text[:first], state))
        tail = self.ids(self.into(text[last:], START, out))
        return np.concatenate([np.array(head, np.uint32), self.cache.of(self.units(text[first:last])), np.array(tail, np.uint32)])

    def encode(self, text):
        return self.cache.of(self.units(self.normal(text)))

    def encode_each(self, texts):
        """Ids of each text, some code points at a time."""
        held, size = [], 0
        for text in texts:
            held.append(self.units(self.normal(text)))
            size += len(text)
            if size >= TOGETHER:
                yield from self.cache.of_each(held)
                held, size = [], 0
        if held:
            yield from self.cache.of_each(held)

    def decode(self, ids):
        return spelling(self.path).decode(ids)


class Spelling:
    """The bytes of each id; all that decoding needs of a model."""

    def __init__(self, path):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text = np.array([self.bytes(sp, i) for i in range(sp.vocab_size())], dtype=object)

    @staticmethod
    def bytes(sp, i):
        if sp.is_byte(i):
            return bytes([int(sp.id_to_piece(i)[3:5], 16)])
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            return b""
        return sp.id_to_piece(i).replace(SPACE, " ").encode()

    def decode(self, ids):
        """The text of ids; a byte sequence that is no character becomes a replacement mark."""
        out = b"".join(self.text[np.asarray(ids, np.int64)].tolist()).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


@cache
def pieces(path):
    return Pieces(path)


@cache
def spelling(path):
    return Spelling(path)


def combine(a, b):
    """Max-plus product of two transfer matrices, {(in, out): weight}."""
    by_in = {}
    for (s, t), w in b.items():
        by_in.setdefault(s, []).append((t, w))
    out = {}
    for (s, t), w in a.items():
        for u, v in by_in.get(t, []):
            if w + v > out.get((s, u), -np.inf):
                out[s, u] = w + v
    return out


def scan(matrices):
    """State at each cut (with both ends) of the best path through all chunks."""
    before = [{(START, START): 0.0}]
    for m in matrices:
        before.append(combine(before[-1], m))
    states = [START]
    for k in range(len(matrices) - 1, -1, -1):
        ways = [(before[k][START, s] + w, s) for (s, t), w in matrices[k].items() if t == states[-1] and (START, s) in before[k]]
        states.append(max(ways)[1])
    return states[::-1]


STATE = "struct<piece:string,over:int>"


def _cut(path, chunk):
    def run(batches):
        model = pieces(path)
        for batch in batches:
            rows = []
            for row, i, text in zip(batch["_row"], batch["_id"], batch["_text"]):
                text, wide = model.normal(text), model.longest
                for k, at in enumerate(range(0, max(len(text), 1), chunk)):
                    part = text[at : at + chunk]
                    rows.append((row, i, k, text[max(0, at - wide) : at], part, text[at + chunk : at + chunk + wide]))
            yield pd.DataFrame(rows, columns=["_row", "_id", "_k", "_left", "_part", "_right"])

    return run


def _matrices(path):
    def run(batches):
        model = pieces(path)
        for batch in batches:
            for row, k, left, part, right in batch[["_row", "_k", "_left", "_part", "_right"]].itertuples(index=False):
                ways = [{"a": {"piece": a[0], "over": a[1]}, "b": {"piece": b[0], "over": b[1]}, "w": w} for a, b, w in model.matrix(left, part, right)]
                yield pd.DataFrame({"_row": [row], "_k": [k], "_ways": [ways]})

    return run


def _states(frame):
    frame = frame.sort_values("_k")
    state = lambda s: (s["piece"], s["over"])
    found = scan([{(state(w["a"]), state(w["b"])): w["w"] for w in ways} for ways in frame["_ways"]])
    pair = lambda s: {"piece": s[0], "over": s[1]}
    return pd.DataFrame(
        {"_row": frame["_row"], "_k": frame["_k"], "_in": [pair(s) for s in found[:-1]], "_out": [pair(s) for s in found[1:]]}
    )


def _trace(path):
    def run(batches):
        model = pieces(path)
        for batch in sliced(batches, 64):
            ids = [
                model.chunk_ids(part, (a["piece"], a["over"]), (b["piece"], b["over"])).astype(np.int32)
                for part, a, b in zip(batch["_part"], batch["_in"], batch["_out"])
            ]
            yield pd.DataFrame({"_row": batch["_row"], "_id": batch["_id"], "_k": batch["_k"], "ids": ids})

    return run


def encode(docs, path, id_col="doc_id", text_col="text", chunk=CHUNK, decoded=None):
    """id and ``ids`` of every text, as the library gives them without begin and end.

    Texts of more than ``chunk`` code points go through the scan, the others are one chunk.
    A null text counts as empty and has no ids. Repeated rows and null ids are kept.
    ``decoded`` names a further column for the text of the ids, as ``decode`` gives it: the ids
    of short texts are decoded where they are made, and do not go to a second worker.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def whole(batches):
        model = pieces(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                ids = list(model.encode_each(part.column(1).to_pylist()))
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                found = [part.column(0), pa.ListArray.from_arrays(ends, np.concatenate(ids).astype(np.int32))]
                if decoded:
                    found.append(pa.array(map(model.decode, ids), pa.string()))
                yield pa.RecordBatch.from_arrays(found, ["_id", "ids", "_decoded"][: len(found)])

    form = f"_id {kind}, ids array<int>" + (", _decoded string" if decoded else "")
    short = texts.where(F.length("_text") <= chunk).mapInArrow(whole, form)
    giant = texts.where(F.length("_text") > chunk).withColumn("_row", F.monotonically_increasing_id())
    parts = sinks.materialize(
        giant.mapInPandas(_cut(path, chunk), f"_row long, _id {kind}, _k int, _left string, _part string, _right string")
        .repartition("_row", "_k")
    )
    ways = parts.mapInPandas(_matrices(path), f"_row long, _k int, _ways array<struct<a:{STATE},b:{STATE},w:double>>")
    states = ways.groupBy("_row").applyInPandas(_states, f"_row long, _k int, _in {STATE}, _out {STATE}")
    traced = parts.select("_row", "_id", "_k", "_part").join(states, ["_row", "_k"]).mapInPandas(
        _trace(path), f"_row long, _id {kind}, _k int, ids array<int>"
    )
    joined = (
        traced.groupBy("_row")
        .agg(F.first("_id").alias("_id"), F.array_sort(F.collect_list(F.struct("_k", "ids"))).alias("_all"))
        .select("_id", F.flatten("_all.ids").alias("ids"))
    )
    if decoded:
        joined = decode(joined, path, out_col="_decoded")
    return short.union(joined).withColumnsRenamed({"_id": id_col, **({"_decoded": decoded} if decoded else {})})


def decode(encoded, path, ids_col="ids", out_col="text"):
    """Add the text of each row's ids; null ids give a null text, no ids an empty one."""

    def run(batches):
        model = spelling(path)
        for batch in sliced(batches):
            yield batch.assign(**{out_col: [None if x is None else model.decode(x) for x in batch[ids_col]]})

    kept = [c for c in encoded.columns if c != out_col]
    fields = [f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in kept]
    return encoded.select(*kept).mapInPandas(run, ", ".join([*fields, f"`{out_col}` string"]))
