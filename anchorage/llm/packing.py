"""Best-fit packing by a grouping genetic algorithm on islands.

Texts become token pieces of at most the sequence length. Full pieces are sequences of
their own. The others are dealt into blocks by hash; a block is packed by several
islands, each with a population of packings, in parallel. Crossover takes whole
well-filled sequences of one parent into the other, drops what would be there twice, and
puts displaced pieces back by best fit, largest first. After each epoch the best packing
of an island moves to the next island of its block. Seeds follow from block, island and
epoch, so a repeated task gives the same packing.
"""

import os
import unicodedata
import zlib
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import functions as F

from anchorage.llm.common import TOGETHER
from anchorage.llm.spelled import Words
from anchorage.llm.tokens import SPACE
from anchorage.sources import sinks

# fixed values: how the lower-casing word BPE cuts a text; white space is dropped
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
GAPS = regex.compile(f"[{SPACE}]+")
BLOCK, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 4096, 3, 3, 6, 4


class WordIds:
    """Ids of whole texts; the library encodes each different word once."""

    def __init__(self, path):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.words = Tokenizer(self.whole.model)  # the same vocabulary in memory, without normalizer and added tokens
        self.words.pre_tokenizer = self.whole.pre_tokenizer
        added = self.whole.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items()}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")" if added else r"((?!))")
        vocab = self.words.get_vocab(with_added_tokens=False)
        self.ending = np.zeros(max(vocab.values()) + 1, bool)
        self.ending[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.chunks = Words(self.learn)
        self.same, self.odd = set(), set()

    def agrees(self, char):
        """Whether the library lower-cases and cuts a character as Python does; newer ones may differ."""
        if unicodedata.category(char) in ("Cn", "Cs"):
            return False
        around = f"a{char}a {char} 1{char}1 .{char}."
        normal = self.whole.normalizer.normalize_str(around)
        if normal != unicodedata.normalize("NFC", around).lower() and not char.isspace():
            return False
        cut = [normal[a:b] for _, (a, b) in self.whole.pre_tokenizer.pre_tokenize_str(normal)]
        return cut == [w for part in GAPS.split(normal) for w in WORDS.findall(part)]

    def known(self, text):
        """Whether all characters of a text are cut alike; each is asked about once."""
        if text.isascii():
            return True
        chars = set(text)
        for c in chars - self.same - self.odd:
            (self.same if self.agrees(c) else self.odd).add(c)
        return self.odd.isdisjoint(chars)

    def normal(self, text):
        if "Σ" in text:  # the library lower-cases letter by letter, Python looks at a sigma's place
            return self.whole.normalizer.normalize_str(text)
        return unicodedata.normalize("NFC", text).lower()

    def learn(self, words):
        """Ids of new words in a row, and how many each has."""
        found = [self.library(words[k : k + 4096]) for k in range(0, len(words), 4096)]
        return [np.concatenate(x) for x in zip(*found)]

    def library_ids(self, text):
        return np.array(self.words.encode(text, add_special_tokens=False).ids, np.uint32)

    def library(self, words):
        """Ids and their numbers by the library, all in one text: a word's last id is one that ends words.

        Where the words cannot be told apart, each half is tried; a single one has then no ids (-1).
        """
        ids = np.array(self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ending[ids]) + 1
        if len(ends) == len(words) and ends[-1] == len(ids):
            return ids, np.diff(ends, prepend=0)
        half = len(words) // 2
        if not half:
            return ids[:0], np.array([-1])
        return [np.concatenate(x) for x in zip(self.library(words[:half]), self.library(words[half:]))]

    def parts(self, text):
        """A text in parts that are cut into words, or the library's ids where it may cut otherwise."""
        if not self.known(text):
            self.whole.encode_special_tokens = True  # no mark is in here
            return [np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)]
        text, out, at = self.normal(text), [], 0
        while len(text) - at > TOGETHER and (gap := GAPS.search(text, at + TOGETHER)):
            out.append(text[at : gap.start()])
            at = gap.end()
        return [*out, text[at:]]

    def encode(self, text):
        return next(self.encode_each([text]))

    def encode_each(self, texts):
        """Ids of each text; the words of some texts are looked up together."""
        held, size = [], 0
        for text in texts:
            found = []
            for i, p in enumerate(self.marks.split(text)):
                found += [np.array([self.special[p]], np.uint32)] if i % 2 else self.parts(p)
            held.append(found)
            size += len(text)
            if size >= TOGETHER:
                yield from self.together(held)
                held, size = [], 0
        if held:
            yield from self.together(held)

    def together(self, held):
        found = self.looked_up(p for parts in held for p in parts if isinstance(p, str))
        for parts in held:
            parts = [next(found) if isinstance(p, str) else p for p in parts]
            yield parts[0] if len(parts) == 1 else np.concatenate(parts)

    def looked_up(self, texts):
        """Ids of each text; as many as have TOGETHER characters at once."""
        held, size = [], 0
        for text in chain(texts, [None]):
            if text is not None:
                held.append(text)
                size += len(text)
            if size >= TOGETHER or (text is None and held):
                for t, ids in zip(held, self.chunks.of_each(held)):
                    yield self.library_ids(t) if ids is None else ids
                held, size = [], 0


@cache
def word_ids(path):
    return WordIds(path)


def pieces(docs, path, length=2048, end_id=0, id_col="doc_id", text_col="text"):
    """Token pieces of every text: id, piece, start, length, ids_crc32.

    A text's ids are followed by ``end_id``; only longer ones are cut. A null text counts
    as empty and is one piece of one id. Repeated rows give their pieces again.
    """

    def run(batches):
        model = word_ids(path)
        for batch in batches:
            rows = []
            for i, ids in zip(batch["_id"], model.encode_each(batch["_text"])):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), length)):
                    part = ids[at : at + length]
                    rows.append((i, k, at, len(part), zlib.crc32(part.tobytes())))
            yield pd.DataFrame(rows, columns=[id_col, "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return texts.mapInPandas(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


# --- packings: lists of sequences, each a list of positions in the block's sizes


def best_fit(packing, items, sizes, length):
    """Put items, largest first, each into the fullest sequence that takes it."""
    free, mask = {}, 0
    for b, seq in enumerate(packing):
        room = length - sum(sizes[i] for i in seq)
        free.setdefault(room, []).append(b)
        mask |= 1 << room
    for i in sorted(items, key=lambda i: -sizes[i]):
        size = sizes[i]
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = free[room]
            b = at.pop()
            if not at:
                mask ^= 1 << room
            packing[b].append(i)
        else:
            b, room = len(packing), length
            packing.append([i])
        room -= size
        free.setdefault(room, []).append(b)
        mask |= 1 << room
    return packing


def fitness(packing, sizes, length):
    """Fewer sequences first, then fuller ones (mean square of the fill)."""
    fill = np.array([sum(sizes[i] for i in seq) for seq in packing]) / length
    return -len(packing), float((fill**2).mean())


def crossover(a, b, sizes, length, rng):
    """Well-filled sequences of b go into a whole; displaced pieces are put back by best fit."""
    fill = np.array([sum(sizes[i] for i in seq) for seq in b])
    chosen = np.flatnonzero((fill >= np.quantile(fill, rng.uniform(0.3, 0.9))) & (rng.random(len(b)) < 0.7))
    inside = {i for k in chosen for i in b[k]}
    kept, displaced = [list(b[k]) for k in chosen], []
    for seq in a:
        if inside.isdisjoint(seq):
            kept.append(list(seq))
        else:
            displaced += [i for i in seq if i not in inside]
    return best_fit(kept, displaced, sizes, length)


def mutate(packing, sizes, length, rng):
    """Empty the least filled sequences and a few others, and put their pieces back."""
    fill = np.array([sum(sizes[i] for i in seq) for seq in packing]) + rng.uniform(0, 0.1 * length, len(packing))
    out = set(np.argsort(fill)[: max(2, len(packing) // 10)].tolist())
    kept = [list(s) for k, s in enumerate(packing) if k not in out]
    return best_fit(kept, [i for k in out for i in packing[k]], sizes, length)


def evolve(population, sizes, length, generations, rng):
    """Some generations; a packing than which none can have fewer sequences ends them and stays alone."""
    least = -(-sum(sizes) // length)
    score = lambda p: fitness(p, sizes, length)
    population = sorted(population, key=score, reverse=True)
    for _ in range(generations):
        if len(population[0]) <= least:
            return population[:1]
        a, b = rng.choice(len(population), 2, replace=False) if len(population) > 1 else (0, 0)
        child = crossover(population[a], population[b], sizes, length, rng)
        if rng.random() < 0.5:
            child = mutate(child, sizes, length, rng)
        population = sorted([*population, child], key=score, reverse=True)[:POPULATION]
    return population


def _first_population(sizes, length, rng):
    out = [best_fit([], range(len(sizes)), sizes, length)]
    if len(out[0]) <= -(-sum(sizes) // length):
        return out
    for _ in range(POPULATION - 1):  # best fit in a blurred order
        blurred = np.array(sizes) * rng.uniform(0.8, 1.0, len(sizes))
        packing = []
        for part in np.array_split(np.argsort(-blurred), 8):
            best_fit(packing, part.tolist(), sizes, length)
        out.append(packing)
    return out


def _pack(packing, n):
    """Sequence number of each piece, as bytes."""
    out = np.zeros(n, np.int32)
    for k, seq in enumerate(packing):
        out[seq] = k
    return out.tobytes()


def _unpack(data):
    numbers = np.frombuffer(data, np.int32)
    order = np.argsort(numbers, kind="stable")
    return [p.tolist() for p in np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1)] if len(order) else []


ISLAND = "_block long, _island int, _sizes binary, _packings array<binary>"


def _epoch(length, epoch):
    def run(batches):
        for batch in batches:
            rows = []
            for block, island, data, packings in batch[["_block", "_island", "_sizes", "_packings"]].itertuples(index=False):
                sizes = np.frombuffer(data, "<i4").tolist()
                rng = np.random.default_rng([block, island, epoch])
                population = [_unpack(p) for p in sorted(packings)] or _first_population(sizes, length, rng)
                best = [_pack(p, len(sizes)) for p in evolve(population, sizes, length, GENERATIONS, rng)]
                rows.append((block, island, data, best))
                rows.append((block, (island + 1) % ISLANDS, data, best[:1]))  # the elite moves on
            yield pd.DataFrame(rows, columns=["_block", "_island", "_sizes", "_packings"])

    return run


def _best(length):
    def run(batches):
        for batch in batches:
            rows = []
            for block, ids, data, packings in batch[["_block", "_rows", "_sizes", "_packings"]].itertuples(index=False):
                sizes = np.frombuffer(data, "<i4").tolist()
                found = [_unpack(p) for p in sorted(set(packings))]
                packing = max(found, key=lambda p: fitness(p, sizes, length))
                for k, seq in enumerate(packing):
                    at = 0
                    for i in sorted(seq):
                        rows.append((ids[i], block * (1 << 32) + k, at))
                        at += sizes[i]
            yield pd.DataFrame(rows, columns=["_row", "sequence_id", "offset"])

    return run


def _binary(batches):
    for batch in batches:
        batch["_sizes"] = [np.asarray(s, "<i4").tobytes() for s in batch["_lengths"]]
        yield batch[["_block", "_rows", "_sizes"]]


def pack(table, length=2048, size_col="length"):
    """Add ``sequence_id`` and ``offset`` to a table of pieces, whose sizes are 1 to ``length``.

    Sequences hold at most ``length`` and have no gaps. Every row is packed, repeated
    ones too; a null size counts as 0. An empty table gives an empty one.
    """
    size = F.coalesce(F.col(size_col), F.lit(0))
    rows = sinks.materialize(table.withColumn("_row", F.monotonically_increasing_id()))
    short = rows.where(size < length).select("_row", size.cast("int").alias("_size"))
    blocks = max(1, -(-short.count() // BLOCK))
    dealt = (
        short.groupBy(F.pmod(F.xxhash64("_row"), F.lit(blocks)).alias("_block"))
        .agg(F.array_sort(F.collect_list(F.struct("_row", "_size"))).alias("_all"))
        .select("_block", F.col("_all._row").alias("_rows"), F.col("_all._size").alias("_lengths"))
        .mapInPandas(_binary, "_block long, _rows array<long>, _sizes binary")
    )
    dealt = sinks.materialize(dealt)
    islands = dealt.select(
        "_block",
        F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("_island"),
        "_sizes",
        F.array().cast("array<binary>").alias("_packings"),
    ).repartition("_block", "_island")
    for epoch in range(EPOCHS):
        islands = (
            islands.mapInPandas(_epoch(length, epoch), ISLAND)
            .groupBy("_block", "_island")
            .agg(F.first("_sizes").alias("_sizes"), F.flatten(F.collect_list("_packings")).alias("_packings"))
        )
    packed = (
        islands.groupBy("_block")
        .agg(F.flatten(F.collect_list("_packings")).alias("_packings"))
        .join(dealt, "_block")
        .mapInPandas(_best(length), "_row long, sequence_id long, offset long")
    )
    return rows.join(packed, "_row", "left").select(
        *[rows[c] for c in table.columns],
        F.coalesce("sequence_id", -1 - F.col("_row")).alias("sequence_id"),
        F.coalesce("offset", F.lit(0)).cast("long").alias("offset"),
    )
