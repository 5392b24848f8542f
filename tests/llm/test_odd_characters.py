"""Word ids of characters that Python and the tokenizer library may see differently."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from anchorage.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def model():
    return packing.WordIds(PATH), Tokenizer.from_file(PATH)


def same(model, text):
    ours, library = model
    return ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_characters_of_all_planes(model):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    chars = chars[:0x3000] + chars[0x3000::23]
    for k in range(0, len(chars), 40):
        text = " ".join(f"a{c}B{c}" for c in chars[k : k + 40])
        assert same(model, text), text


def test_unassigned_and_new_characters_among_others(model):
    texts = ["\U0003f50dÅ", "ᠽ\U00019139", "\U0003e030▁", "Ᲊ", "꟔", "\U00010d50", "plain \U0003f50d <|endoftext|> ΑΣ"]
    rng = random.Random(2)
    some = ["a", "B", " ", "'s", "é", "é", "\n", "<|endoftext|>", "12", "\x1c", "\x85", "日本", "ΑΣ", "İ", "!"]
    for _ in range(2000):
        texts.append("".join(rng.choice(some) if rng.random() < 0.6 else chr(rng.randrange(0xE000, 0x110000)) for _ in range(rng.randint(0, 14))))
    for text in texts:
        assert same(model, text), repr(text)


def test_words_that_run_into_each_other_are_left_to_the_library(model):
    ours, library = model
    ours.ending[:] = False  # as if no id ended a word
    try:
        fresh = packing.WordIds(PATH)
        fresh.ending = ours.ending
        text = "some words, and the library's ids"
        assert fresh.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    finally:
        ours.ending[:] = packing.WordIds(PATH).ending
