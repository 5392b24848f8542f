"""Words met before, kept in arrays: a text is cut and its words are looked up without a Python object a word."""

from functools import cache

import numpy as np
import regex

from anchorage.llm.common import POWERS, U64, gathered, spans_hash
from anchorage.llm.tokens import SPACE

BLANK, LETTER, NUMBER, OTHER = range(4)


@cache
def kinds():
    """What each code point is, as the cutting pattern sees it."""
    everything = "".join(map(chr, range(0x110000)))
    out = np.full(len(everything), OTHER, np.uint8)
    for kind, of in ((BLANK, f"[{SPACE}]+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for found in regex.finditer(of, everything):
            out[found.start() : found.end()] = kind
    return out


def cut(codes):
    """(starts, ends) of the words in code points of which the last is a blank, and which are in words.

    A word is a run of letters, one number, or a run of other characters; an apostrophe
    that begins one takes the letters of s, t, re, ve, m, ll or d with it.
    """
    kind = kinds()[codes]
    begins = np.empty(len(kind), bool)
    begins[0] = True
    np.not_equal(kind[1:], kind[:-1], out=begins[1:])
    begins |= kind == NUMBER
    quote = np.flatnonzero(codes[:-1] == ord("'"))
    quote = quote[begins[quote] & (kind[quote + 1] == LETTER)]
    if len(quote):
        a, b = codes[quote + 1], codes[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = (np.isin(a, [ord("r"), ord("v")]) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        begins[quote[one | two] + 1] = False
        for some, size in ((one, 1), (two, 2)):
            begins[quote[some] + size + 1] = True
    solid = kind != BLANK
    ends = solid.copy()
    ends[:-1] &= begins[1:]
    return np.flatnonzero(begins & solid), np.flatnonzero(ends) + 1, solid


class Words:
    """Ids of words met before.

    ``learn(words)`` gives the ids of some new words in a row and how many each has; -1: it
    has none of its own. A word is found by a hash and then compared letter by letter. At
    ``most`` words, or 16 times as many characters, those that were not met again are dropped.
    """

    def __init__(self, learn, most=1 << 19):
        self.learn, self.most = learn, most
        self.bits = (2 * most - 1).bit_length()
        self.forget()

    def forget(self):
        self.count = self.n_ids = self.n_chars = 0
        self.ids, self.chars = np.zeros((2, 1 << 16), np.uint32)
        self.hash, (self.met, self.own) = np.zeros(1 << 12, U64), np.zeros((2, 1 << 12), bool)
        # where a word's ids and its characters begin, and how many there are
        self.first, self.size, self.spot, self.length = np.zeros((4, 1 << 12), np.int64)
        self.clear()

    def clear(self):
        self.marks, self.places = np.zeros(1 << self.bits, U64), np.zeros(1 << self.bits, np.int32)

    def find(self, h):
        """Place of each hash among the words, or -1."""
        slot = (h >> U64(64 - self.bits)).astype(np.int64)
        mark = self.marks[slot]
        at = np.where(mark == h, self.places[slot], -1)
        rest = np.flatnonzero((mark != h) & (mark != 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)
            mark = self.marks[slot[rest]]
            hit = mark == h[rest]
            at[rest[hit]] = self.places[slot[rest[hit]]]
            rest = rest[~hit & (mark != 0)]
        return at

    def enter(self, h, first):
        """Put different new hashes into the table, for the words from ``first`` on."""
        while self.count + len(h) > 3 << (self.bits - 2):  # so that a search ends
            self.bits += 1
            self.clear()
            self.enter(self.hash[: self.count], 0)
        slot = (h >> U64(64 - self.bits)).astype(np.int64)
        rest = np.arange(len(h))
        while len(rest):
            free = self.marks[slot[rest]] == 0
            put = rest[free]
            self.marks[slot[put]] = h[put]  # of several for one slot the last stays
            won = self.marks[slot[put]] == h[put]
            self.places[slot[put[won]]] = first + put[won]
            rest = np.r_[rest[~free], put[~won]]
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)

    def thin(self):
        """Keep only words that were met again, or none if these are too many."""
        keep = np.flatnonzero(self.met[: self.count])
        if 2 * len(keep) > self.most or self.length[keep].sum() > 8 * self.most:
            return self.forget()
        ids, chars = gathered(self.ids, self.first, self.size, keep), gathered(self.chars, self.spot, self.length, keep)
        h, own, size, length = self.hash[keep], self.own[keep], self.size[keep], self.length[keep]
        self.forget()
        self.add(h, own, ids, size, chars, length)

    def add(self, h, own, ids, size, chars, length):
        k = self.count
        self.enter(h, k)
        for name, used, new in (
            ("ids", self.n_ids, ids),
            ("chars", self.n_chars, chars),
            ("hash", k, h),
            ("met", k, np.zeros(len(h), bool)),
            ("own", k, own),
            ("first", k, self.n_ids + np.cumsum(size) - size),
            ("size", k, size),
            ("spot", k, self.n_chars + np.cumsum(length) - length),
            ("length", k, length),
        ):
            have = getattr(self, name)
            if used + len(new) > len(have):
                have = np.r_[have[:used], np.zeros(max(used + len(new), 3 * used // 2) - used, have.dtype)]
                setattr(self, name, have)
            have[used : used + len(new)] = new
        self.count, self.n_ids, self.n_chars = k + len(h), self.n_ids + len(ids), self.n_chars + len(chars)

    def of_each(self, texts):
        """Ids of each text; None where a word has none of its own."""
        text = " ".join(texts) + " "
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts, ends, solid = cut(codes)
        sums = np.zeros(len(codes) + 1, U64)
        np.cumsum(codes * POWERS.reach(len(codes) + 1).up[: len(codes)], dtype=U64, out=sums[1:])
        h = spans_hash(sums, starts, ends) | U64(1)
        at = self.find(h)
        if (self.count >= self.most or self.n_chars >= 16 * self.most) and (at < 0).any():
            self.thin()
            at = self.find(h)
        self.met[at[at >= 0]] = True
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new, some, back = np.unique(h[missing], return_index=True, return_inverse=True)
            a, b = starts[missing[some]], ends[missing[some]]
            ids, size = self.learn([text[i:j] for i, j in zip(a.tolist(), b.tolist())])
            at[missing] = self.count + back
            chars = gathered(codes, a, b - a, np.arange(len(a)))
            self.add(new, size >= 0, ids, np.maximum(size, 0), chars, b - a)
        same = self.length[at] == ends - starts
        if same.all():
            wrong = np.flatnonzero(solid)[gathered(self.chars, self.spot, self.length, at) != codes[solid]]
            same[np.searchsorted(starts, wrong, "right") - 1] = False
        else:  # two words of one hash
            same[:] = False
        same &= self.own[at]
        words = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
        odd = np.cumsum(np.r_[0, ~same])[words]
        ends = np.cumsum(np.r_[0, self.size[at]])[words].tolist()
        ids = gathered(self.ids, self.first, self.size, at)
        return [ids[i:j] if n else None for i, j, n in zip(ends, ends[1:], (odd[1:] == odd[:-1]).tolist())]
