"""Byte-pair tokens of many short texts at once: the one path through the tokens of each, in arrays.

All places of all texts go through a trie of the tokens together; then the last token of
each prefix is found for all texts, one length of prefix after the other, by the joints.
"""

import numpy as np

from anchorage.llm.bpe import REMEMBERED

TOP = 0x110000  # characters


def codes(texts):
    """The code points of the texts in a row."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


class Lattice:
    """Tokens by number: those of ``names``, then each character that is none, at ``len(names)`` plus its code point."""

    def __init__(self, bpe):
        self.bpe, self.names, self.joints = bpe, sorted(bpe.tokens), {}
        self.most = len(self.names) + TOP
        number = {name: i for i, name in enumerate(self.names)}
        nodes, edges = {"": 0}, []
        for name in self.names:
            for end in range(1, len(name) + 1):
                if name[:end] not in nodes:
                    node = nodes[name[:end]] = len(nodes)
                    edges.append((nodes[name[: end - 1]] * TOP + ord(name[end - 1]), node, number.get(name[:end], -1)))
        self.edges, self.nodes, self.tokens = np.array(sorted(edges), np.int64).reshape(-1, 3).T.copy()
        # 0: not yet asked whether the merges make the token, 1: they do, 2: they do not
        self.whole = np.array([len(name) == 1 for name in self.names] + [True], np.uint8)

    def name(self, token):
        return self.names[token] if token < len(self.names) else chr(token - len(self.names))

    def found(self, char, end):
        """Where tokens begin, their lengths and numbers; ``end``: of each character's text."""
        n_names, out = len(self.names), []
        at, node = np.arange(len(char)), np.zeros(len(char), np.int64)
        for n in range(1, self.bpe.longest + 1):
            if not len(at):
                break
            step = char[at + n - 1]
            edge = node * TOP + step
            i = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            there = self.edges[i] == edge
            token = np.where(there, self.tokens[i], -1)
            if n == 1:
                token = np.where(token < 0, n_names + step, token)
            hit = token >= 0
            out.append((at[hit], np.full(int(hit.sum()), n), token[hit]))
            there &= at + n < end[at]
            at, node = at[there], self.nodes[i[there]]
        begin, n, token = map(np.concatenate, zip(*out))
        kind = np.minimum(token, n_names)
        for t in np.unique(kind[self.whole[kind] == 0]).tolist():
            self.whole[t] = 1 if self.bpe.whole(self.names[t]) else 2
        good = self.whole[kind] == 1
        return begin[good], n[good], token[good]

    def fits(self, before, token):
        """Whether the merges leave each two tokens alone; each joint is looked into once."""
        joint, place = np.unique(before * self.most + token, return_inverse=True)
        out = list(map(self.joints.get, joint.tolist()))
        if None in out:
            if len(self.joints) >= REMEMBERED // 2:
                self.joints.clear()
            for i, (known, j) in enumerate(zip(out, joint.tolist())):
                if known is None:
                    out[i] = self.joints[j] = self.bpe.alone(*map(self.name, divmod(j, self.most)))
        return np.array(out, bool)[place]

    def paths(self, texts):
        """Token numbers of all texts in a row, and how many each text has; no text is empty."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        if not len(size):
            return size, size
        stop = np.cumsum(size)
        first, char = np.repeat(stop - size, size), codes(texts)
        begin, n, token = self.found(char, np.repeat(stop, size))
        prefix = begin + n - first[begin]
        order = np.argsort(prefix, kind="stable")
        begin, n, token = begin[order], n[order], token[order]
        last, width = np.full(len(char), -1), np.zeros(len(char), np.int64)
        cuts = np.searchsorted(prefix[order], np.arange(1, int(size.max()) + 2)).tolist()
        for a, b in zip(cuts, cuts[1:]):
            s, k, t = begin[a:b], n[a:b], token[a:b]
            fit = s == first[s]
            rest = np.flatnonzero(~fit)
            before = last[s[rest] - 1]
            rest, before = rest[before >= 0], before[before >= 0]
            fit[rest] = self.fits(before, t[rest])
            end = (s + k - 1)[fit]
            last[end], width[end] = t[fit], k[fit]
        # back from the ends of the texts
        on, at, head = np.zeros(len(char), bool), stop - 1, stop - size
        if (last[at] < 0).any():
            raise ValueError("a text that no sequence of tokens makes up")
        while len(at):
            on[at] = True
            at = at - width[at]
            more = at >= head
            at, head = at[more], head[more]
        return last[on], np.add.reduceat(on, stop - size, dtype=np.int64)
