"""Very long texts without a blank: memory follows their length."""

import random
import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from anchorage.llm import common, sentences, tokens

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def runs():
    rng = random.Random(3)
    letters = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    return ["there" * 14 + "x", letters(3000, "abcdefgh"), letters(2000, "日本語中文字漢字"), "-" * 500, " " * 300 + "a", "é" * 200]


def test_counts_of_long_runs_are_the_librarys():
    model, library = tokens.Prefixes(BYTES), Tokenizer.from_file(BYTES)
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for text in runs():
        counts = model.counts(text)
        assert len(counts) == len(text) + 1
        for k in [1, 7, 63, 64, 65, 66, 100, len(text) // 2, len(text)]:
            k = min(k, len(text))
            assert counts[k] == size(text[:k])
        assert model.fit(text, [])[0] == size(text)
        whole, (fits,) = model.fit(text, [20])
        assert counts[fits] <= 20 and all(c > 20 for c in counts[fits + 1 :])


def test_long_units_are_the_librarys():
    model = sentences.Pieces(PIECES)
    for text in ["there" * 2000, *runs()]:
        assert model.encode(text).tolist() == model.sp.encode(text)


@pytest.mark.parametrize("of", ["there", "abcdefghijklmnopqrstuvwxyz0123456789"])
def test_a_million_letters_in_bounded_memory(of):
    work = f"""
import random, resource
from anchorage.llm import sentences, tokens
rng, of = random.Random(1), {of!r}
text = of * (10**6 // len(of)) if of == "there" else "".join(rng.choice(of) for _ in range(10**6))
model, pieces = tokens.Prefixes({BYTES!r}), sentences.Pieces({PIECES!r})
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
assert model.fit(text, [1024])[0] > 10**5
pieces.encode(text[: sentences.CHUNK])
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    grown = subprocess.run([sys.executable, "-c", work], capture_output=True, text=True, check=True).stdout
    assert int(grown) < 300_000  # KB


def test_remembered_ids_are_bounded_by_characters():
    ids = common.Ids(lambda new: [[len(p)] for p in new], 64)
    for k in range(200):
        piece = "x" * (100 + k)
        assert ids.of([piece, "y"]).tolist() == [100 + k, 1]
        assert sum(map(len, ids.known)) <= 16 * ids.half + len(piece) + 1
    assert np.array_equal(ids.of([]), np.zeros(0))


def test_many_different_words_in_bounded_memory():
    work = f"""
import random, resource
from anchorage.llm import sentences
rng, ends = random.Random(1), ["ation", "ment", "the", "ou", "er", "ing", "ñ", "日", "ha", "st"]
words = lambda n: " ".join("".join(rng.choices(ends, k=6)) for _ in range(n))
model = sentences.Pieces({PIECES!r})
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for _ in range(200):
    model.encode(words(3000))
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    grown = subprocess.run([sys.executable, "-c", work], capture_output=True, text=True, check=True).stdout
    assert int(grown) < 90_000  # KB


def test_texts_together_are_the_librarys():
    model, rng = sentences.Pieces(PIECES), random.Random(5)
    texts = ["", *runs(), "", "﻿\U000e0001 日xy", "aé" * 40, *("".join(rng.choices("the anou.ñ日!", k=70)) for _ in range(300)), ""]
    want = [model.sp.encode(t) for t in texts]
    assert [ids.tolist() for ids in model.encode_each(texts)] == want
    assert [ids.tolist() for ids in model.encode_each(texts)] == want
