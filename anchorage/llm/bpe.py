"""Byte-pair merges seen from the joints: which tokens may stand side by side.

A sequence of tokens is what the merges make of its text exactly if every two
neighbours, taken alone, are left as they are. So the last token of a prefix is the one
token that ends there and agrees with the last token of the prefix before it.
"""

from array import array
from itertools import chain

FOREVER = 1 << 60
REMEMBERED = 1 << 20
SHORT = 64  # longer texts are not remembered, so what is held follows one text, not its square


class Bpe:
    """``rank(a, b)``: order of the merge of two tokens, or None; ``splits``: token -> (left, right, rank)."""

    def __init__(self, rank, tokens, splits=None):
        self.rank, self.tokens = rank, tokens
        self.longest = max(map(len, tokens), default=1)
        self.splits = {} if splits is None else splits
        self.joints, self.ends = {}, {}

    def merge(self, text):
        """The merges carried out, and the last of them as (left, right, rank)."""
        parts, last = [text[i : i + 1] for i in range(len(text))], None
        while True:
            best = min(
                ((r, i) for i in range(len(parts) - 1) if (r := self.rank(parts[i], parts[i + 1])) is not None),
                default=None,
            )
            if best is None:
                return parts, last
            r, i = best
            last = (parts[i], parts[i + 1], r)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def split(self, token):
        """How a whole token came about, or None for a single symbol or an unreachable token."""
        if token not in self.splits:
            parts, last = self.merge(token)
            self.splits[token] = last if len(parts) == 1 and len(token) > 1 else None
        return self.splits[token]

    def whole(self, token):
        return len(token) == 1 or self.split(token) is not None

    def stays(self, a, b):
        """Whether a, b side by side are left alone, remembered."""
        known = self.joints.get((a, b))
        if known is None:
            if len(self.joints) >= REMEMBERED // 2:
                self.joints.clear()
            known = self.joints[a, b] = self.alone(a, b)
        return known

    def alone(self, a, b):
        """Whether a, b side by side are left alone: undo their merges, the latest first, and look
        for a merge across the joint that would have come before the next step on either side."""
        x, y, x_until, y_until = a, b, FOREVER, FOREVER
        while True:
            r = self.rank(x, y)
            # of equal merges the left one comes first
            if r is not None and r < x_until and r <= y_until:
                return False
            sx, sy = self.split(x), self.split(y)
            if sx is None and sy is None:
                return True
            if sy is None or (sx is not None and sx[2] > sy[2]):
                x, x_until = sx[1], sx[2]
            else:
                y, y_until = sy[0], sy[2]

    def prefixes(self, text):
        """Fill ``ends``: prefix -> (last token, number of tokens), for all prefixes of a short piece.

        A symbol that is no token stands alone. None for a prefix that no sequence makes up.
        """
        ends, tokens, longest, joints = self.ends, self.tokens, self.longest, self.joints
        n = len(text)
        if text in ends:
            return ends
        if len(ends) >= REMEMBERED // 2:
            ends.clear()
        done = n - 1
        while done and text[:done] not in ends:
            done -= 1
        token = ends[text[:done]] if done else None
        token = token[0] if token else text[:0]
        at = [None] * (n + 1)
        for end in range(done + 1, n + 1):
            # just one token fits; mostly it is the one before with the symbol added, or a short one
            found, begin = None, end - 1 - len(token)
            for start in chain((begin,), range(end - 1, max(0, end - longest) - 1, -1)):
                token = text[start:end]
                if token in tokens or end - start == 1:
                    if not start:
                        if self.whole(token):
                            found = (token, 1)
                            break
                    elif (before := at[start] if start > done else ends[text[:start]]) is not None:
                        fits = joints.get((before[0], token))
                        if fits or (fits is None and self.whole(token) and self.stays(before[0], token)):
                            found = (token, before[1] + 1)
                            break
            ends[text[:end]] = at[end] = found
            token = found[0] if found else text[:0]
        return ends

    def path(self, text):
        """Of each prefix, by its length: where its last token begins (-1: no sequence), and its tokens.

        Two numbers a prefix, whatever the length of the text.
        """
        n = len(text)
        begins, counts = array("q", [-1]) * (n + 1), array("q", [0]) * (n + 1)
        if n <= SHORT:
            ends = self.prefixes(text) if n else {}
            for end in range(1, n + 1):
                if (found := ends[text[:end]]) is not None:
                    begins[end], counts[end] = end - len(found[0]), found[1]
            return begins, counts
        tokens, longest, joints = self.tokens, self.longest, self.joints
        for end in range(1, n + 1):
            for start in chain((begins[end - 1],), range(end - 1, max(0, end - longest) - 1, -1)):
                token = text[start:end] if start >= 0 else None
                if token not in tokens and end - start != 1:
                    continue
                if start:
                    if begins[start] < 0:
                        continue
                    before = text[begins[start] : start]
                    fits = joints.get((before, token))
                    if not (fits or (fits is None and self.whole(token) and self.stays(before, token))):
                        continue
                elif not self.whole(token):
                    continue
                begins[end], counts[end] = start, counts[start] + 1
                break
        return begins, counts

    def count(self, text):
        """The number of tokens of a piece."""
        return self.prefixes(text)[text][1] if 0 < len(text) <= SHORT else self.path(text)[1][-1]

    def tokenized(self, text):
        """The tokens of a piece."""
        out, end = [], len(text)
        if 0 < end <= SHORT:
            ends = self.prefixes(text)
            while end:
                out.append(ends[text[:end]][0])
                end -= len(out[-1])
        else:
            begins = self.path(text)[0]
            while end:
                out.append(text[begins[end] : end])
                end = begins[end]
        return out[::-1]
