"""Exact token counts at every prefix of a text, for byte-level BPE vocabularies.

The text is cut into the pieces that the tokenizer never merges across. Within a piece,
dynamic programming over its prefixes finds the last token of each prefix: the token
whose joint with the last token of the prefix before it is left alone by the merges.
That needs one step per prefix and no re-encoding, and gives the count of every prefix.
Counts inside a piece plus the counts of the pieces before it answer any question on
truncation or budgets.
"""

import json
from functools import cache
from itertools import accumulate

import numpy as np
import pandas as pd
import regex
from pyspark.sql import functions as F

from anchorage.llm.bpe import REMEMBERED, SHORT, Bpe

# fixed values: the cut of GPT-2's byte-level BPE, with white space as Unicode has it
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
BLANK = set(regex.findall(f"[{SPACE}]", "".join(map(chr, range(0x3001)))))
CONTRACTIONS = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}


def byte_letters():
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Prefixes:
    """Prefix counts for one vocabulary file (tokenizers' JSON, byte-level BPE)."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in byte_letters().items()}
        as_bytes = lambda s: bytes(to_byte[c] for c in s)
        self.special = [t["content"] for t in spec["added_tokens"]]
        vocab = {as_bytes(k) for k in spec["model"]["vocab"] if k not in self.special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        rank = {(as_bytes(a), as_bytes(b)): i for i, (a, b) in enumerate(pairs)}
        splits = {a + b: (a, b, i) for (a, b), i in reversed(rank.items())}
        splits |= {bytes([b]): None for b in range(256)}
        self.bpe = Bpe(lambda a, b: rank.get((a, b)), vocab, splits)
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.totals = {}

    def add(self, piece):
        out = self.bpe.count(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= SHORT:
            if len(self.totals) >= REMEMBERED // 2:
                self.totals.clear()
            self.totals[piece] = out
        return out

    def inside(self, pieces, k):
        """Counts after each code point of piece k, from the start of the piece."""
        piece = pieces[k]
        if piece in CONTRACTIONS:  # a part of one is two pieces, the apostrophe and a letter
            return [1, *[2] * (len(piece) - 2), self.total(piece)]
        counts = self.bpe.path(piece.encode("utf-8", "surrogatepass"))[1]
        ends = accumulate(len(c.encode("utf-8", "surrogatepass")) for c in piece)
        out = [counts[end] for end in ends]
        # white space that ends a prefix is one piece with all white space before it
        if k and piece[0] in BLANK and pieces[k - 1][-1] in BLANK and pieces[k - 1][0] in BLANK:
            out[0] = self.total(pieces[k - 1] + piece[0]) - self.total(pieces[k - 1])
        return out

    def total(self, piece):
        known = self.totals.get(piece)
        return self.add(piece) if known is None else known

    def plain(self, text):
        """Counts of all prefixes of a text without special strings (without the empty one)."""
        out, base, pieces = [], 0, PIECES.findall(text)
        for k, p in enumerate(pieces):
            out += [base + c for c in self.inside(pieces, k)]
            base += self.total(p)
        return out

    def counts(self, text):
        """Token counts of all prefixes of a text, by code points (the first is 0).

        A special string counts as one token once it is whole, as the library has it.
        """
        out, base, at = [0], 0, 0
        for start, end in [*self.marks(text), (len(text), len(text))]:
            # parts of the special string are ordinary text, cut together with what comes before
            part = [base, *(base + c for c in self.plain(text[at : max(start, end - 1)]))]
            out += part[1:]
            if end > start:
                base = part[start - at] + 1
                out.append(base)
            at = end
        return out

    def marks(self, text):
        return [(m.start(), m.end()) for m in self.split.finditer(text)]

    def fit(self, text, limits):
        """The whole count, and for each limit the length of the longest prefix within it.

        Counts at the ends of pieces say in which piece a limit is reached; only that one
        is looked into.
        """
        if self.marks(text):
            counts = np.array(self.counts(text))
            return int(counts[-1]), [int(np.flatnonzero(counts <= x)[-1]) for x in limits]
        pieces, known, add = PIECES.findall(text), self.totals, self.add
        total = [c if (c := known.get(p)) is not None else add(p) for p in pieces]
        after = np.cumsum(total, dtype=np.int64)
        whole, fits = int(after[-1]) if pieces else 0, []
        for x in limits:
            if whole <= x:
                fits.append(len(text))
                continue
            k = int(np.searchsorted(after, x, "left")) + 1 if x > 0 else -1
            k, found = min(k, len(pieces) - 1), None
            while k >= 0 and not found:
                base = int(after[k]) - total[k]
                found = [i for i, c in enumerate(self.inside(pieces, k), 1) if base + c <= x]
                k -= 1
            fits.append(sum(map(len, pieces[: k + 1])) + found[-1] if found else 0)
        return whole, fits


@cache
def prefixes(path):
    """One per worker process; the vocabulary file lies beside the installed library."""
    return Prefixes(path)


def table(docs, path, id_col="doc_id", text_col="text"):
    """Prefix table: id, n_bytes, n_tokens and ``steps``.

    ``steps`` holds, as little-endian int16, how much each code point of the text adds to
    the count; ``prefix_counts`` turns it back. A null text counts as empty. One row per
    row of ``docs``, with null ids and repeated rows kept; other columns are ignored.
    """

    def run(batches):
        model = prefixes(path)
        for batch in batches:
            counts = [model.counts(t) for t in batch["_text"]]
            yield pd.DataFrame(
                {
                    id_col: batch["_id"],
                    "n_bytes": batch["_bytes"],
                    "n_tokens": [c[-1] for c in counts],
                    "steps": [np.diff(c).astype("<i2").tobytes() for c in counts],
                }
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return _texts(docs, id_col, text_col).mapInPandas(
        run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, steps binary"
    )


def prefix_counts(steps):
    """Counts of all prefixes from the ``steps`` of one row."""
    return np.r_[0, np.cumsum(np.frombuffer(steps, dtype="<i2"))]


def _texts(docs, id_col, text_col):
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("_id"), text.alias("_text"), F.octet_length(text).cast("long").alias("_bytes")
    )


def budgets(docs, path, limits, id_col="doc_id", text_col="text"):
    """Whole counts and, for each limit, the longest prefix that fits; from one pass.

    ``fits``: for each limit the largest number of code points whose prefix has at most
    that many tokens. Cases as in ``table``, whose counts it reads off piece by piece.
    """

    def run(batches):
        model = prefixes(path)
        for batch in batches:
            found = [model.fit(t, limits) for t in batch["_text"]]
            yield pd.DataFrame(
                {
                    id_col: batch["_id"],
                    "n_bytes": batch["_bytes"],
                    "n_tokens": [n for n, _ in found],
                    "fits": [f for _, f in found],
                }
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return _texts(docs, id_col, text_col).mapInPandas(
        run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, fits array<long>"
    )
