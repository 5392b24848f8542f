"""Substring dedup by windows against a plain loop, on odd and empty input."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from anchorage.llm import windows


def dedup_by_force(rows, length):
    """Counter of (id, n_words, n_removed, hash)"""
    first, split = {}, []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        split.append((i, w))
        for k in range(len(w) - length + 1):
            x = tuple(w[k : k + length])
            if i is not None and (x not in first or (i, k) < first[x]):
                first[x] = (i, k)
    out = Counter()
    for i, w in split:
        gone = set()
        for k in range(len(w) - length + 1):
            if i is not None and first[tuple(w[k : k + length])] < (i, k):
                gone.update(range(k, k + length))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def found(table, length):
    return Counter((r[0], r.n_words, r.n_removed, r.kept_sha256) for r in windows.dedup(table, length).collect())


@pytest.mark.parametrize("length", [1, 5, 20])
def test_dedup(docs, corpus, nothing, monkeypatch, length):
    want = dedup_by_force([*corpus, (None, "no id at all here")], length)
    assert sum(r[2] > 0 for r in want) > 10
    assert found(docs, length) == want
    monkeypatch.setattr(windows, "CROWDED", 2)  # windows of repeated anchors dealt out one by one
    monkeypatch.setattr(windows, "MOST_CROWDS", 1 << 40)
    monkeypatch.setattr(windows, "SLICE", 50)
    assert found(docs, length) == want
    assert windows.dedup(nothing, length).collect() == []


def test_repeats_in_one_text_and_many_copies(spark):
    rng = random.Random(4)
    prose = lambda n: " ".join(str(rng.randrange(40)) for _ in range(n))
    passage = prose(60)
    far = 1 << 61  # no float holds such an id
    texts = [f"{prose(9)} {passage}\n\n{prose(30)}\t{passage} {prose(3)}" for _ in range(40)]
    texts += ["x " * 300, "x\x0b" * 50, passage, passage.replace(" ", " "), None, "", " \n", "é日 " * 30]
    rows = list(enumerate(texts)) + [(90, texts[0])] * 200 + [(far, "x y"), (far, passage), (far, "a " + passage), (None, passage)]
    rows += [(far + 1 + k, prose(5) + " " + passage) for k in range(9)]
    rng.shuffle(rows)
    table = spark.createDataFrame([(t, i, 1, 2) for i, t in rows], "text string, doc_id long, _doc int, _key int").repartition(5)
    assert found(table, 20) == dedup_by_force(rows, 20)


def test_words_of_blocks_and_long_words(monkeypatch):
    rng = random.Random(6)
    text = " ".join("ab"[rng.randrange(2)] * rng.choice([1, 3, 9000, 30000]) + rng.choice(["", "\n\x0c "]) for _ in range(60)).encode()
    data = np.frombuffer(text, np.uint8)
    want = [(m.start(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    for block in (1 << 22, 1000):
        monkeypatch.setattr(windows, "BLOCK", block)
        start, hashes = windows.words_of(data)
        assert start.tolist() == [a for a, _ in want]
        assert len({*zip(hashes.tolist(), [w for _, w in want])}) == len(set(hashes.tolist())) == len({w for _, w in want})


def test_sketch_never_underestimates():
    rng = np.random.default_rng(1)
    parcels = [(rng.integers(0, 1 << 32, 3000).astype(np.uint32) % np.uint32(9000), rng.integers(1, 5, 3000)) for _ in range(4)]
    true = Counter()
    for cells, counts in parcels:
        for c, n in zip(cells.tolist(), counts.tolist()):
            true[c] += n
    for (cells, _), estimate in zip(parcels, windows.estimates(parcels)):
        exact = np.array([true[c] for c in cells.tolist()])
        assert (estimate >= exact).all() and (estimate == exact).mean() > 0.9


def test_stretches_are_whole():
    found = windows.Texts(["a b c d e f", "", "a b", "x a b c d e"], 4)
    assert sorted(zip(found.text.tolist(), found.first.tolist())) and found.n.sum() == 3 + 3
    own, place, _ = found.windows(np.arange(len(found.n)))
    assert sorted(zip(found.text[own].tolist(), place.tolist())) == [(0, 0), (0, 1), (0, 2), (3, 0), (3, 1), (3, 2)]
