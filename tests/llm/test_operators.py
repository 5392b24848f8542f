"""Each operator against a brute-force version or an exact round trip, on odd and empty input."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from anchorage.llm import components, jaccard, langid, licenses, packing, quality, sentences, sketches, suffixes, tokens, urls
from anchorage.llm.common import shingles

BYTES, WORDS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = ["a", "B", " ", "  ", "'", "re", "'RE", "'s", "ll", "the", "é", "e\u0301", "\n", "\t", "!", "<|endoftext|>", "<|endo", "12", "\x1c", "\x85", "\u3000", "日本", "😀", "ΑΣ", "İ", "ing", " hello", "\xa0", "!!", "."]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 12))) for _ in range(n)]


# --- 1


def jaccard_by_force(rows, threshold=0.8):
    sets = {(i, t): frozenset(shingles(t, 5).tolist()) for i, t in rows if i is not None and t}
    sets = {k: s for k, s in sets.items() if s}
    classes = {}
    for (i, _), s in sets.items():
        classes[s] = min(i, classes.get(s, i))
    links = {c: set() for c in classes.values()}
    items = list(classes.items())
    for a, x in items:
        for b, y in items:
            if x != y and len(a & b) >= threshold * len(a | b):
                links[x].add(y)
    group = {c: c for c in links}
    for _ in links:
        for c, near in links.items():
            low = min([group[c], *(group[x] for x in near)])
            for x in (c, *near):
                group[x] = low
    out = Counter()
    for i, t in rows:
        c = classes.get(sets.get((i, t)))
        out[(i, i, 0, i) if c is None else (i, c, len(links[c]), group[c])] += 1
    return out


def test_jaccard_join(docs, corpus, nothing, monkeypatch):
    want = jaccard_by_force([*corpus, (None, "no id at all here")])
    assert sum(n > 0 for _, _, n, _ in want) > 10
    assert Counter(map(tuple, jaccard.join(docs).collect())) == want
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", 1)  # all buckets in blocks
    assert Counter(map(tuple, jaccard.join(docs).collect())) == want
    assert jaccard.join(nothing).collect() == []


def test_jaccard_refuses_thresholds_that_the_bands_miss(docs):
    for threshold in (0.5, 0.7):
        with pytest.raises(ValueError, match="meet in no band"):
            jaccard.join(docs, threshold=threshold)
    jaccard.require_bands(0.8)


def test_pruning_keeps_true_pairs_and_drops_others():
    plan = jaccard.least_matches(0.8, 1e-6, 16)
    assert [n for n, _ in plan] == list(range(16, 129, 16))
    # a pair at the threshold matches in about 0.8 n values, and one at 0.3 fails early
    assert all(least < 0.8 * n for n, least in plan) and plan[1][1] > 0.3 * 32
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    a = np.stack([jaccard.minhash(np.r_[base[k:], rng.integers(0, 1 << 63, k, dtype=np.uint64)]) for k in range(0, 40, 4)])
    found = set()
    for band in range(jaccard.BANDS):
        i, j = jaccard.candidates(a, a, band, plan, True)
        pairs = set(zip(i.tolist(), j.tolist()))
        assert not found & pairs
        found |= pairs
    assert found == {(i, j) for i in range(10) for j in range(i + 1, 10)}


def test_overlap_by_pairs_and_by_matrix():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, 120).astype(np.uint64)) for _ in range(12)]
    i, j = np.triu_indices(12, 1)
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]
    assert jaccard.overlap(sets, i, j).tolist() == want
    assert jaccard.overlap(sets, i[:5], j[:5]).tolist() == want[:5]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(50 + i, 50) for i in range(1, 40)] + [(7, 7), (None, 3), (99, 98), (98, 99)]
    found = {r.node: r.root for r in components.smallest(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 1 for i in range(1, 31)} | {50 + i: 50 for i in range(40)} | {98: 98, 99: 98}
    assert components.smallest(spark.createDataFrame([], "a long, b long")).collect() == []


# --- 2


def test_prefix_counts_are_the_librarys():
    from tokenizers import Tokenizer

    model, library = tokens.Prefixes(BYTES), Tokenizer.from_file(BYTES)
    for text in odd_texts(300, 1):
        want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert model.counts(text) == want, text
        limits = list(range(9))
        assert model.fit(text, limits) == (want[-1], [max(i for i, n in enumerate(want) if n <= x) for x in limits])


def test_token_tables(docs, corpus, nothing):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "").ids)) for i, t in corpus)
    found = tokens.budgets(docs.where("doc_id is not null"), BYTES, [50])
    assert Counter((r[0], r[1], r[2]) for r in found.collect()) == want
    row = tokens.table(docs.where("text = ''"), BYTES).first()
    assert tokens.prefix_counts(row["steps"]).tolist() == [0]
    texts = {r.doc_id: r.text for r in docs.limit(9).collect()}
    for r in tokens.table(docs.limit(9), BYTES).collect():
        counts = tokens.prefix_counts(r["steps"])
        assert len(counts) == len(texts[r["doc_id"]] or "") + 1 and counts[-1] == r["n_tokens"]
    assert tokens.budgets(nothing, BYTES, [1]).collect() == []


# --- 3


def test_word_ids_are_the_librarys():
    from tokenizers import Tokenizer

    model, library = packing.WordIds(WORDS), Tokenizer.from_file(WORDS)
    for text in odd_texts(400, 2):
        assert model.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_packing_is_whole_and_tight(docs, corpus, nothing):
    from tokenizers import Tokenizer

    library, length = Tokenizer.from_file(WORDS), 256
    table = packing.pieces(docs.where("doc_id is not null"), WORDS, length=length)
    rows = packing.pack(table, length=length).collect()
    want = Counter()
    for i, t in corpus:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), length)):
            part = ids[at : at + length]
            want[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert sum(n for _, n in parts) <= length
    assert len(sequences) <= len(packing.best_fit([], range(len(rows)), [r.length for r in rows], length))
    assert packing.pack(packing.pieces(nothing, WORDS)).collect() == []


def test_genetic_steps_keep_every_piece():
    rng = np.random.default_rng(1)
    sizes = rng.integers(300, 900, 200).tolist()
    a = packing.best_fit([], range(200), sizes, 1000)
    b = [[i] for i in range(200)]
    for packed in (packing.crossover(a, b, sizes, 1000, rng), packing.mutate(a, sizes, 1000, rng)):
        assert sorted(i for seq in packed for i in seq) == list(range(200))
        assert all(sum(sizes[i] for i in seq) <= 1000 for seq in packed)
    start = [b, packing.best_fit([], range(100), sizes, 1000) + [[i] for i in range(100, 200)]]
    best = packing.evolve(start, sizes, 1000, 30, rng)[0]
    assert len(best) <= len(start[1])
    assert packing._unpack(packing._pack(a, 200)) == [sorted(s) for s in a]


# --- 4


def quality_by_force(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(w, w[1:], w[2:]))
    again = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), failed)


def test_quality_base(spark, docs, corpus, nothing):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    more = [(9000, "a b c a b c a b c\na b\n\na b\n \t\n#*x"), (9001, "x\x0by\x0cz é\u00a0ü")]
    rows = [*corpus, *more]
    found = quality.base(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in found) == Counter((i, *quality_by_force(t)) for i, t in rows)
    assert quality.clean(docs).count() == docs.count() and quality.clean(nothing).collect() == []


def test_quality_lines(spark):
    prose = "\n".join(" ".join(f"word{i}{c}" for c in "abcdefgh") + "." for i in range(12))
    menu = "\n".join(f"Home | About {i} | Contact {i} | Help {i} | More {i}" for i in range(30))
    shout = " ".join(f"WORD{i}!!" for i in range(60))
    symbols = " ".join(f"word{i}$$$" for i in range(60))
    rows = [("clean", prose), ("mixed", prose + "\nHome | About | Contact\nclick here to sign up"), ("menu", menu), ("shout", shout), ("symbols", symbols)]
    found = {r.doc_id: r for r in quality.clean(spark.createDataFrame([*rows, ("null", None)], "doc_id string, text string")).collect()}
    assert {i for i, r in found.items() if r.kept} == {"clean", "mixed"}
    assert found["clean"].clean_text == prose == found["mixed"].clean_text
    assert found["mixed"].n_removed == 2 and found["null"].clean_text is None


# --- 5


def test_sentencepiece_and_its_scan():
    model, rng = sentences.Pieces(PIECES), random.Random(3)
    for text in odd_texts(300, 3):
        want = model.sp.encode(text)
        assert model.encode(text).tolist() == want
        assert model.decode(want) == text
        normal, size, wide = model.normal(text), rng.choice([1, 2, 3, 5, 8, 17]), model.longest
        cut = [(normal[max(0, a - wide) : a], normal[a : a + size], normal[a + size : a + size + wide]) for a in range(0, max(1, len(normal)), size)]
        matrices = [{(a, b): w for a, b, w in model.matrix(*c)} for c in cut]
        states = sentences.scan(matrices)
        assert [i for (_, part, _), a, b in zip(cut, states, states[1:]) for i in model.chunk_ids(part, a, b).tolist()] == want
        if len(matrices) > 2:  # any grouping
            x, y, z = matrices[:3]
            left, right = sentences.combine(sentences.combine(x, y), z), sentences.combine(x, sentences.combine(y, z))
            assert left.keys() == right.keys() and all(abs(left[k] - right[k]) < 1e-6 for k in left)


def test_sentencepiece_tables(docs, corpus, nothing):
    model = sentences.pieces(PIECES)
    some = docs.where("doc_id is not null")
    encoded = sentences.encode(some, PIECES, chunk=200)
    want = Counter((i, tuple(model.sp.encode(t or ""))) for i, t in corpus)
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == want
    assert Counter((r.doc_id, r.text) for r in sentences.decode(encoded, PIECES).collect()) == Counter((i, t or "") for i, t in corpus)
    assert sentences.encode(nothing, PIECES).collect() == []


# --- 6


def test_url_rules(spark):
    rows = [
        ("http://Blog.Example.ORG/es/5?x#y", "blog.example.org", "/es/5", "example.org/es/", "block"),
        ("http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://a.com/de/?q://z", "a.com", "/de/", "com/de/", "block"),
        ("http://com/fr/#", "com", "/fr/", "com/fr/", "allow"),
        ("http://notexample.org?x", "notexample.org", "", None, "allow"),
        ("http://xorg/", "xorg", "/", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([], "key long, bad boolean")
    found = urls.judge(pages, labels).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == [r[1:] for r in rows]
    assert urls.judge(pages.limit(0), labels).collect() == []


def test_url_mining(spark):
    rows = [(i, f"http://{'win.bets' if i % 4 == 0 else 'good'}.net/{'x' if i % 3 else 'y'}/{i}") for i in range(400)]
    labels = [(i, i % 4 == 0 and i % 3 > 0) for i in range(0, 400)] + [(4, None), (None, True)]
    pages = spark.createDataFrame([*rows, rows[4]], "page_id long, url string")
    found = urls.judge(pages, spark.createDataFrame(labels, "key long, bad boolean"), min_confidence=0.9).collect()
    assert len(found) == 401
    assert all((r.verdict == "block") == (r.page_id % 4 == 0 and r.page_id % 3 > 0) for r in found)
    assert {len(r.mined_rule.split()) > 1 for r in found if r.mined_rule} == {True}


def rules_by_force(rows):
    base = sum(b for _, b in rows) / len(rows)
    seen, found = Counter(), {}
    for tokens_, is_bad in rows:
        for k in range(1, len(tokens_) + 1):
            for some in itertools.combinations(sorted(tokens_), k):
                seen[some, True] += is_bad
                seen[some, False] += 1
    for some in {s for s, _ in seen}:
        c, n = seen[some, True], seen[some, False]
        if c >= 5 and c / n >= 0.5 and c / n > base:
            if c * math.log(c / n / base) + (c < n and (n - c) * math.log((n - c) / n / (1 - base))) >= math.log(1e6):
                found[some] = (n, c)
    return {s: v for s, v in found.items() if not any(set(o) < set(s) for o in found)}


@pytest.mark.parametrize("narrow", [10, 3, 0])
def test_url_rules_are_all_that_evidence_bears(spark, narrow):
    rng = random.Random(8)
    rows = []
    for _ in range(900):
        some = {t for t in "abcdef" if rng.random() < 0.3}
        some |= {"twin" + t for t in some & {"a", "b"}}  # on the same pages
        rows.append((sorted(some), rng.random() < (0.9 if {"a", "c"} <= some or "b" in some and "d" in some else 0.1)))
    rows += [(["f", "spam"], True)] * 12
    found, _ = urls.mine(spark.createDataFrame([*rows, (["a"], None)], "tokens array<string>, bad boolean"), narrow=narrow)
    want = rules_by_force(rows)
    assert ("spam",) in want and ("b", "d") in want and ("d", "twinb") in want
    assert {tuple(r.tokens): (r.pages, r.bad) for r in found.collect()} == want


def test_url_rules_of_a_template_with_many_tokens(spark):
    """Thirty tokens on the same bad pages, each on good pages too: 435 pairs, not 2^30 sets."""
    shared = [f"t{k:02d}" for k in range(30)]
    rows = [(shared, True)] * 16 + [([t, f"u{i % 7}"], False) for i, t in enumerate(shared * 30)]
    found, _ = urls.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"))
    assert {tuple(r.tokens) for r in found.collect()} == set(itertools.combinations(shared, 2))


def test_url_rules_need_the_same_evidence_at_every_size(spark):
    def verdicts(good, spam):
        n = good + spam
        pages = spark.range(n).select(
            F.col("id").alias("page_id"),
            F.concat(F.lit("http://"), F.when(F.col("id") < spam, "tail.test").otherwise("good.net"), F.lit("/"), "id").alias("url"),
        )
        labels = spark.range(n).select(F.col("id").alias("key"), ((F.col("id") < spam) | (F.col("id") % 4 == 0)).alias("bad"))
        return {r.verdict for r in urls.judge(pages, labels).where("host = 'tail.test'").select("verdict").distinct().collect()}

    assert verdicts(30_000, 20) == {"block"}  # under a thousandth of the labelled pages
    assert verdicts(100, 1) == {"allow"}  # one page proves nothing
    assert verdicts(100, 20) == {"block"}


# --- 7


def test_language_id(spark, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(langid.learnable(docs))
    found = langid.predict(docs.withColumn("held", langid.held_out()), model).where("held")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert right > 0.97 and n > 200
    assert (model["weights"] == 0).mean() > 0.5 and model["t"] > 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "the")], "doc_id long, text string")
    rows = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and rows[4].lang_pred in model["langs"]
    assert all(0 <= r.score <= 1 for r in rows.values())
    empty = langid.fit(langid.learnable(nothing))
    assert empty["langs"] == [] and langid.predict(odd, empty).where("lang_pred = 'und'").count() == 4
    ids = [*range(50), None]
    folds = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", langid.held_out().alias("h"))
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in folds.collect())


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 3, 400)
    scores = 9 * (np.eye(3)[np.where(rng.random(400) < 0.7, labels, (labels + 1) % 3)])
    assert langid.temperature(scores, labels) > 2
    assert langid.temperature([], []) == 1.0


# --- 8


def dedup_by_force(rows, length):
    data, first = [(i, (t or "").encode()) for i, t in rows], {}
    for i, b in data:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            first[s] = min(first.get(s, i), i)
    out = Counter()
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = True
        kept = bytes(np.frombuffer(b, "u1")[~gone])
        out[i, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hot", [1, 32])
def test_suffix_dedup(docs, corpus, nothing, hot):
    found = suffixes.dedup(docs, keep=["_id", "score"], hot=hot)
    assert {"_id", "score", "kept_text"} <= set(found.columns)
    rows = found.where("doc_id is not null").collect()
    want = dedup_by_force(corpus, 50)
    assert sum(r[2] for r in want) > 2000
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.starts), r.kept_sha256) for r in rows) == want
    assert found.where("doc_id is null").first().n_removed == 0
    assert suffixes.dedup(nothing).collect() == []


@pytest.mark.parametrize("hot", [1, 32])
def test_suffix_dedup_of_one_id_with_several_texts(spark, hot):
    rng = random.Random(3)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, other = prose(120), prose(90)
    rows = [(1, prose(30) + passage + prose(40)), (1, other), (2, prose(400) + passage + prose(60)), (2, prose(200)), (2, prose(70))]
    rows += [(2, other[:70]), (2, rows[2][1]), (3, prose(100) + passage[20:] + other), (3, passage), (4, prose(300) + other)]
    want = dedup_by_force(rows, 50)
    assert sum(r[2] > 0 for r in want) == 5 and sum(r[0] == 2 and r[2] == 0 for r in want) == 2
    found = suffixes.dedup(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.starts), r.kept_sha256) for r in found) == want


# --- 9


def test_sketches():
    a, b = "one two three four five six seven eight", "one two three four five six seven nine"
    x, y = sketches.sketch(a), sketches.sketch(b)
    assert sketches.resemblance(x, y) == 3 / 5 and sketches.containment(x, y) == pytest.approx(3 / 4)
    assert sketches.distinct(x) == 4 and sketches.from_text(sketches.to_text(x)).tolist() == x.tolist()
    words = [f"w{i}" for i in range(5000)]
    parts = [" ".join(words[k : k + 1004]) for k in range(0, 5000, 1000)]
    merged = sketches.merge(*[sketches.sketch(p) for p in parts])
    whole = sketches.sketch(" ".join(words))
    assert merged.tolist() == whole.tolist()
    assert sketches.distinct(whole) == pytest.approx(4996, rel=0.4)
    assert sketches.resemblance(whole, sketches.sketch(" ".join(words[1000:]))) == pytest.approx(0.8, abs=0.15)


def test_merged_fingerprints(spark):
    rows = [("a", "x " * 3 + "b c d e f"), ("a", "g h i j k l"), (None, "g h i j k l"), ("e", "")]
    parts = sketches.fingerprints(spark.createDataFrame(rows, "doc_id string, text string"))
    found = {r.doc_id: r.fingerprint for r in sketches.merged_fingerprints(parts, "doc_id").collect()}
    assert found["a"] == sketches.to_text(sketches.merge(sketches.sketch(rows[0][1]), sketches.sketch(rows[1][1])))
    assert found["e"] == "" and found[None] == sketches.to_text(sketches.sketch(rows[2][1]))


def test_edit_likeness(spark, corpus, nothing, monkeypatch):
    def force(rows):
        rows, out = sorted([(i, t or "") for i, t in rows], reverse=True), Counter()
        for k, (i, t) in enumerate(rows):
            following, half = rows[(k + 1) % len(rows)][1], len(t) // 2
            mixed = t[: len(t) - half] + following[:half]
            a, b, c = map(sketches.sketch, (t, mixed, following))
            out[i, len(t), hashlib.sha256(mixed.encode()).hexdigest(), sketches.to_text(a), sketches.to_text(b), sketches.resemblance(a, b), sketches.resemblance(a, c)] += 1
        return out

    for rows, bucket in ((corpus, 512), (corpus, 7), (corpus[:1], 512), ([(i * 10**7 - 5, t) for i, t in corpus[:30]], 512)):
        monkeypatch.setattr(sketches, "BUCKET", bucket)
        found = sketches.edit_likeness(spark.createDataFrame([*rows, (None, "x")], "doc_id long, text string")).collect()
        assert Counter(map(tuple, found)) == force(rows)
    assert sketches.edit_likeness(nothing).collect() == []


# --- 10


def test_license_templates(spark, docs, nothing):
    rows = [
        ("Licensed under the Apache License, Version 2.0.", "apache", "apache,apache-2.0", 1.0, 3, 3),
        ("This is under GNU General Public License; MIT license", "gpl,mit", "gpl,mit", 0.5, 3, 7),
        ("Released under the terms of the MIT License", "mit", "mit,mit-notice", 1.0, 6, 6),
        ("licensed under CC BY-NC 4.0", "cc-by", "cc-by,cc-by-notice", 1.0, 2, 2),
        ("Copyright (c) 2020 by Some Body. All rights reserved", "", "copyright-notice", 1.0, None, None),
        ("redistribution and use in source and binary form", "", "", 0.0, None, None),
        ("Gnü general public license", "", "", 0.0, None, None),
        (None, "", "", 0.0, None, None),
        ("", "", "", 0.0, None, None),
    ]
    table = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "doc_id long, text string")
    found = licenses.scan(table).orderBy("doc_id").collect()
    assert [(r.base_labels, r.labels, r.score, r.first_word, r.last_word) for r in found] == [r[1:] for r in rows]
    assert licenses.scan(docs).count() == docs.count() and licenses.scan(nothing).collect() == []


def filled(template, optional, words=1):
    """A text of a template, with all or no optional parts, in upper case and with signs."""
    text, before = template, None
    while before != text:
        before, text = text, re.sub(r"\[\[([^\[\]]*)\]\]", r"\1" if optional else "", text)
    text = re.sub(r"\{\{(\d+)\.\.(\d+)\}\}", lambda m: "Holder " * min(words, int(m[2])), text)
    return ", ".join(text.upper().split())


def test_whole_licenses():
    both = tuple([*licenses.TEMPLATES, *licenses.WHOLE])
    labels = lambda text: {m[0] for m in licenses.matches(licenses.words_of(text), both)}
    for label, template in licenses.WHOLE:
        for optional in (True, False):
            for words in (1, 4):
                text = filled(template, optional, words)
                assert label in labels("Some words before; " + text + " and after.")
                assert not ({"bsd-2-clause", "bsd-3-clause"} - {label}) & labels(text)
        # any one mandatory word changed or left out, to the last, is refused
        plain = filled(template, False).split(", ")
        for k, word in enumerate(plain):
            if word != "HOLDER":
                assert label not in labels(" ".join([*plain[:k], "zzz", *plain[k + 1 :]]))
                if k and "HOLDER" not in (plain[k - 1], plain[min(k + 1, len(plain) - 1)]):
                    assert label not in labels(" ".join([*plain[:k], *plain[k + 1 :]])), (label, k, word)
        assert label not in labels(filled(template, False, 0)) or "{{" not in template


def test_whole_licenses_match_their_sql(spark):
    import duckdb

    from anchorage.llm import sql

    texts = [filled(t, o, w) for _, t in licenses.WHOLE for o in (True, False) for w in (0, 1, 4, 9)]
    texts += [t.replace("WARRANTIES", "GUARANTEES") for t in texts] + [None, ""] + texts[:2]
    rows = [(i, t) for i, t in enumerate(texts)]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    want = duckdb.sql(sql.LICENSES).df().set_index("doc_id").labels.to_dict()
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.labels for r in found} == want
    again = [r.labels for r in licenses.scan(spark.createDataFrame([rows[0]] * 3, "doc_id long, text string")).collect()]
    assert again == [want[0]] * 3  # repeated rows are kept


def test_automata():
    def accepts(template, text):
        return licenses.Automaton(template).accepts(licenses.words_of(text), 0)

    assert accepts("a [[ b [[ c ]] ]] d", "a d") == 2 and accepts("a [[ b [[ c ]] ]] d", "a b c d x") == 4
    assert accepts("a [[ b ]] d", "a c d") is None
    assert accepts("a {{1..2}} d", "a x d") == 3 and accepts("a {{1..2}} d", "a d") is None and accepts("a {{1..2}} d", "a x y z d") is None
    for bad in ("[[ a ]]", "{{1..1}} a", "a ]]", "a [[ b"):
        with pytest.raises(ValueError):
            licenses.Automaton(bad)
    assert licenses.places(b" a b a b a ", b"a b a") == [0, 2]
