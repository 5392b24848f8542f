"""Words that are kept and looked up in arrays."""

import random
import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from anchorage.llm import packing, spelled

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts(n=300):
    rng = random.Random(4)
    some = ["a", "re", "the", "ll", "'", "'s", "'re", "'v", "''t", "é", "日本", "½", "12", " ", " ", "\n", "　", "\x1c", "-", "Σ", "!?"]
    return ["", " ", "'", "'l", *("".join(rng.choices(some, k=rng.randint(1, 60))) for _ in range(n))]


def library(some):
    whole = Tokenizer.from_file(PATH)
    return [whole.encode(t, add_special_tokens=False).ids for t in some]


def test_words_of_one_hash_are_told_apart(monkeypatch):
    want = library(texts())
    for of in (lambda h, n: np.full_like(h, 7), lambda h, n: n.astype(h.dtype)):
        real = spelled.spans_hash
        monkeypatch.setattr(spelled, "spans_hash", lambda sums, a, b: of(real(sums, a, b), b - a))
        model = packing.WordIds(PATH)
        assert [ids.tolist() for ids in model.encode_each(texts())] == want
        assert [model.encode(t).tolist() for t in texts()] == want
        monkeypatch.undo()


def test_a_full_memory_keeps_what_is_met_again():
    learnt = []

    def learn(words):
        learnt.extend(words)
        return np.array([ord(w[-1]) for w in words for _ in w], np.uint32), np.array([len(w) for w in words])

    known, rng = spelled.Words(learn, 64), random.Random(1)
    for k in range(200):
        new = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 90))) for _ in range(20)]
        (ids,) = known.of_each([" ".join(["often", *new])])
        assert ids.tolist() == [ord(w[-1]) for w in ["often", *new] for _ in w]
        assert known.count <= 64 + 21 and known.n_chars <= 16 * 64 + 21 * 90
    assert learnt.count("often") == 1
    known.of_each([" ".join(str(k) + "x" for k in range(10**5, 10**5 + 500))])  # more than the table has room for
    assert known.of_each(["often"])[0].tolist() == [ord("n")] * 5


def test_parts_of_a_long_text_are_the_librarys(monkeypatch):
    want = library(texts() + [" ".join(texts()), "ab1" * 500])
    monkeypatch.setattr(packing, "TOGETHER", 50)
    model = packing.WordIds(PATH)
    assert [ids.tolist() for ids in model.encode_each(texts() + [" ".join(texts()), "ab1" * 500])] == want


@pytest.mark.parametrize("end", ["", ".", ",;"])
def test_many_different_words_take_little_memory(end):
    work = f"""
import random, resource
from anchorage.llm import packing
rng, ends = random.Random(1), ["ation", "ment", "the", "ou", "er", "ing", "ñ", "日", "ha", "st"]
words = lambda n: " ".join("".join(rng.choices(ends, k=6)) + {end!r} for _ in range(n))
model = packing.WordIds({PATH!r})
model.encode(words(3000))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for _ in range(200):
    model.encode(words(3000))
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    grown = subprocess.run([sys.executable, "-c", work], capture_output=True, text=True, check=True).stdout
    assert int(grown) < 140_000, grown  # KB
