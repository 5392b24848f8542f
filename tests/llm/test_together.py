"""Texts encoded and decoded in one worker."""

from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

from anchorage.llm import packing, quality, sentences

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def test_decoded_beside_the_ids(docs, corpus, nothing):
    model = sentences.pieces(PIECES)
    found = sentences.encode(docs.where("doc_id is not null"), PIECES, chunk=200, decoded="back")
    want = Counter((i, tuple(model.sp.encode(t or "")), t or "") for i, t in corpus)
    assert found.columns == ["doc_id", "ids", "back"]
    assert Counter((r.doc_id, tuple(r.ids), r.back) for r in found.collect()) == want
    assert sentences.encode(nothing, PIECES, decoded="back").collect() == []


def test_words_of_many_texts_are_looked_up_together():
    model, library = packing.WordIds(WORDS), Tokenizer.from_file(WORDS)
    library.encode_special_tokens = False
    texts = ["", "the house, the\x1cmouse.", " a  b　c ", "ΟΔΟΣ Σ", "Don't 12½ Ünï", "x" * 300, "\U000e0001 odd", "日本 語"]
    texts += [f"word{k} and.others" + "yes" * (k % 7) for k in range(400)]
    calls, learn = [], model.chunks.learn
    model.chunks.learn = lambda new: calls.append(len(new)) or learn(new)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in model.encode_each(texts)] == want
    assert len(calls) == 1
    assert [model.encode(t).tolist() for t in texts] == want


def test_no_whole_text_is_translated_by_the_quality_rules(docs, capsys):
    quality.clean(docs.where("doc_id is not null")).explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    # a translation goes character by character; one is left, of lines under four words
    assert "translate(text" not in plan and "translate(coalesce" not in plan
    assert "abcdefghijklmnopqrstuvwxyz" not in plan


def test_quality_rules_of_odd_lines(spark):
    lines = {
        "日…\t\t.\x0b\x85": 0,  # ended: what is after the full stop is no end of its own
        "READ more at the shop now": 1,
        "ſubſcribe to a list of news": 0,  # only ASCII letters count without their case
        "a|b | c": 1,
        "#*$%&|<>": 1,
        "\x1c four odd words here": 0,
        " \t\x0b": 0,
        "one two three": 1,
    }
    found = quality.clean(spark.createDataFrame(list(lines.items()), "text string, want int")).collect()
    assert [(r.text, r.n_removed) for r in found] == [(r.text, r.want) for r in found]
    assert {r.text: (r.word_chars, r.n_symbols) for r in found}["#*$%&|<>"] == (8, 8)
    assert all(r.word_chars == sum(c not in " \t\n\x0b\f\r" for c in r.text) for r in found)
