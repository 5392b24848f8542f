"""What the operators share: numpy hashing of words and windows, and sorted groups in a stream."""

from itertools import chain, repeat

import numpy as np
import pandas as pd

U64 = np.uint64
TOGETHER = 1 << 18  # code points of texts whose pieces are looked up together
# an odd multiplier and its inverse modulo 2**64; sums of byte codes times its powers are hashes
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

# a word is a run of ASCII digits and letters and of all bytes beyond ASCII; A-Z count as a-z
_WORD = np.zeros(256, dtype=bool)
_WORD[ord("0") : ord("9") + 1] = _WORD[ord("a") : ord("z") + 1] = _WORD[ord("A") : ord("Z") + 1] = True
_WORD[128:] = True


def _codes(fold):
    codes = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=U64) | U64(1)
    if fold:
        codes[ord("A") : ord("Z") + 1] = codes[ord("a") : ord("z") + 1]
    return codes


EXACT, FOLDED = _codes(False), _codes(True)


def mix(x):
    """Spread the bits of unsigned 64-bit values (in place on a copy)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Powers:
    """Powers of BASE and of its inverse, grown to the longest text met."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=U64)

    def reach(self, n):
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.cumprod(np.r_[U64(1), np.full(n - 1, b, dtype=U64)], dtype=U64) for b in (BASE, INVERSE)
            )
        return self


POWERS = Powers()


def prefix_sums(data, codes):
    """H with H[j] - H[i] = sum of codes times powers over bytes i..j-1."""
    p = POWERS.reach(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(codes[data] * p.up[: len(data)], dtype=U64, out=out[1:])
    return out


def spans_hash(sums, start, end):
    """Hash of bytes start..end-1, whatever their place."""
    return mix((sums[end] - sums[start]) * POWERS.down[start] + (end - start).astype(U64))


def word_hashes(text):
    """64-bit hashes of the words of a text, in order."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = _WORD[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, dtype=U64)
    return spans_hash(prefix_sums(data, FOLDED), start, end)


def shingles(text, n):
    """Sorted distinct hashes of all n-word windows; a shorter text is one window of all its words."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, dtype=U64)
    for i in range(n):
        out *= U64(BASE)
        out += words[i : len(words) - n + 1 + i]
    return np.unique(mix(out))


def sliced(batches, rows=512):
    """The batches in smaller frames, so that what is made of one is small too."""
    for batch in batches:
        for k in range(0, len(batch), rows):
            yield batch.iloc[k : k + rows].reset_index(drop=True)


def sorted_groups(batches, keys):
    """Frames of rows with equal keys, from pandas batches whose rows lie sorted by the keys.

    Holds one batch and one group at a time.
    """
    held = None
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        if not len(batch):
            continue
        change = np.zeros(len(batch), dtype=bool)
        for k in keys:
            v = batch[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = np.flatnonzero(change)
        begin = 0
        for end in cuts:
            yield batch.iloc[begin:end]
            begin = end
        held = batch.iloc[begin:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


class Ids:
    """Ids of pieces of text met before, laid end to end, so that a text is one gather.

    ``learn(new)`` gives a list of ids for each of some new pieces. What is remembered is
    bounded by two halves, in pieces, ids and characters: when one is full, it becomes the older
    one and a new one begins, which takes over what is met again.
    """

    def __init__(self, learn, most=1 << 19):
        self.learn, self.half, self.older = learn, most // 2, ({}, None, None, None)
        self.forget()

    def forget(self):
        self.known, self.used, self.chars = {}, 0, 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.first, self.size = np.zeros((2, 1 << 12), np.int64)

    def remember(self, new):
        """Take in pieces that are not known, each once."""
        met, *place = self.older
        again = [p for p in new if p in met]
        fresh = [p for p in new if p not in met] if again else new
        old = np.fromiter(map(met.__getitem__, again), np.int64, len(again))
        ids = self.learn(fresh) if fresh else []
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        if again:
            size = np.r_[place[2][old], size]
        n, k = self.used + int(size.sum()), len(self.known)
        if n > len(self.flat):
            self.flat = np.r_[self.flat, np.zeros(max(n - len(self.flat), len(self.flat)), np.uint32)]
        if k + len(new) > len(self.first):
            room = np.zeros(max(k + len(new) - len(self.first), len(self.first)), np.int64)
            self.first, self.size = np.r_[self.first, room], np.r_[self.size, room]
        middle = self.used + int(size[: len(again)].sum())
        if again:
            self.flat[self.used : middle] = gathered(*place, old)
        self.flat[middle:n] = list(chain.from_iterable(ids))
        self.first[k : k + len(new)] = self.used + np.cumsum(size) - size
        self.size[k : k + len(new)] = size
        self.known.update(zip(chain(again, fresh), range(k, k + len(new))))
        self.used, self.chars = n, self.chars + sum(map(len, new))

    def places(self, pieces):
        at = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(at < 0)
        if not len(missing):
            return at
        if len(self.known) >= self.half or max(self.used, self.chars) >= 16 * self.half:
            self.older = (self.known, self.flat, self.first, self.size)
            self.forget()
            missing = np.arange(len(pieces))
        new = [pieces[i] for i in missing.tolist()]
        self.remember(list(dict.fromkeys(new)))
        at[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        return at

    def of(self, pieces):
        """Ids of all pieces in a row."""
        return gathered(self.flat, self.first, self.size, at) if len(at := self.places(pieces)) else np.zeros(0, np.uint32)

    def of_each(self, lists):
        """Ids of each list of pieces; the lists are looked up together."""
        at = self.places(list(chain.from_iterable(lists)))
        ends = np.cumsum(np.r_[0, self.size[at]])[np.cumsum([0, *map(len, lists)])]
        ids = gathered(self.flat, self.first, self.size, at)
        return [ids[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]


def gathered(flat, first, size, at):
    """The stretches ``at`` of an array, one after the other."""
    first, size = first[at], size[at]
    first -= np.cumsum(size) - size
    return flat[np.arange(size.sum()) + np.repeat(first, size)]
