"""Language ID: multinomial logistic regression on TF-IDF of character n-grams.

Document frequencies come from all texts that may be learnt from. The regression is
fitted on a bounded sample of them by follow-the-regularised-leader with elastic-net
penalties, so most weights are zero; a part of the sample that it does not see sets the
temperature of its probabilities. Prediction is a pass over the texts.
"""

from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from anchorage.llm.common import U64, mix, sliced

FEATURES = 1 << 15
GRAMS = 3
#: texts to fit on at most, over all languages (on average: they are chosen by a hash)
SAMPLE = 6000
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.2, 0.1, 2
UNKNOWN = "und"


@cache
def _letters():
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def has_letter(text):
    return any(c.isalpha() for c in text)


def gram_counts(text):
    """(features, counts) of the 1- to 3-grams of letters; all else is a single space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(_letters()[codes], codes, np.uint32(32))
    codes = np.r_[np.uint32(32), codes, np.uint32(32)]
    blank = codes == 32
    codes = codes[~(blank & np.r_[False, blank[:-1]])].astype(U64)
    found, key = [], np.zeros(len(codes), U64)
    for n in range(1, GRAMS + 1):
        if len(codes) < n:
            break
        key = key[: len(codes) - n + 1] * U64(0x110000) + codes[n - 1 :]
        found.append(mix(key + U64(n)) >> U64(49))
    counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=FEATURES)
    at = np.flatnonzero(counts)
    return at, counts[at]


def vector(text, idf):
    at, counts = gram_counts(text)
    x = (1 + np.log(counts)) * idf[at]
    norm = np.sqrt((x * x).sum())
    return at, x / norm if norm else x


class Ftrl:
    """Follow-the-regularised-leader (proximal) for a multinomial logistic regression."""

    def __init__(self, classes, features=FEATURES):
        self.z = np.zeros((classes, features))
        self.n = np.zeros((classes, features))

    def weights(self, at=slice(None)):
        z, n = self.z[:, at], self.n[:, at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at, x, label):
        w = self.weights(at)
        p = softmax(w @ x)
        p[label] -= 1
        g = p[:, None] * x
        root = np.sqrt(self.n[:, at])
        self.n[:, at] += g * g
        self.z[:, at] += g - (np.sqrt(self.n[:, at]) - root) / ALPHA * w


def softmax(s):
    e = np.exp(s - s.max())
    return e / e.sum()


def temperature(scores, labels):
    """The temperature of least log loss, by golden-section search of its logarithm."""
    if not len(scores):
        return 1.0
    scores = np.asarray(scores)

    def loss(t):
        s = scores / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), labels]).mean())

    low, high, cut = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - cut * (high - low), low + cut * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts):
    """(feature, n) over all rows of ``_text``; feature -1 counts the texts."""

    def run(batches):
        total, rows = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for text in batch["_text"]:
                at, _ = gram_counts(text)
                total[at] += 1
                rows += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"feature": np.r_[-1, at], "n": np.r_[rows, total[at]]})

    counted = texts.select("_text").mapInPandas(run, "feature long, n long")
    return counted.groupBy("feature").agg(F.sum("n").alias("n"))


def fit(labelled, sample=SAMPLE):
    """Model (languages, weights, temperature, idf) from rows (_key, _text, _lang), none of them null.

    Languages share the sample equally; those with fewer texts give all. What goes to the
    driver is bounded: a count per language and feature, and the model. Without rows the
    model knows no language.
    """
    counts = {r["_lang"]: r["n"] for r in labelled.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    idf = np.zeros(FEATURES)
    if not counts:
        return {"langs": [], "idf": idf, "weights": np.zeros((0, FEATURES), np.float32), "t": 1.0}
    langs = sorted(counts)
    seen = {r["feature"]: r["n"] for r in document_frequencies(labelled).collect()}
    idf[:] = np.log1p(seen.pop(-1))
    for feature, n in seen.items():
        idf[feature] -= np.log1p(n)
    idf += 1
    share, rest = {}, sample
    for k, lang in enumerate(sorted(langs, key=counts.get)):
        share[lang] = min(counts[lang], rest // (len(langs) - k))
        rest -= share[lang]
    bound = F.lit(0.0)
    for lang in langs:
        bound = F.when(F.col("_lang") == lang, F.lit(share[lang] / counts[lang])).otherwise(bound)
    draw = F.pmod(F.xxhash64("_key", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = labelled.withColumn("_draw", draw).where(F.col("_draw") < bound)

    def run(batches):
        rows = pd.concat(batches, ignore_index=True).sort_values(["_draw", "_key", "_text"])
        if not len(rows):
            return
        label = rows["_lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
        order = np.random.default_rng(3).permutation(len(rows))
        texts, label = rows["_text"].to_numpy()[order], label[order]
        model, held = Ftrl(len(langs)), max(1, len(rows) // 5) if len(rows) > 5 else 0
        vectors = [vector(t, idf) for t in texts]
        for _ in range(EPOCHS):
            for (at, x), y in zip(vectors[held:], label[held:]):
                model.learn(at, x, y)
        w = model.weights()
        scores = [w[:, at] @ x for at, x in vectors[:held]]
        yield pd.DataFrame({"w": [w.astype("<f4").tobytes()], "t": [temperature(scores, label[:held])]})

    fitted = chosen.select("_key", "_text", "_lang", "_draw").repartition(1).mapInPandas(run, "w binary, t double").collect()
    w = fitted[0]["w"] if fitted else b"\0" * 4 * FEATURES * len(langs)
    weights = np.frombuffer(w, "<f4").reshape(len(langs), FEATURES)
    return {"langs": langs, "idf": idf, "weights": weights, "t": fitted[0]["t"] if fitted else 1.0}


def predict(docs, model, id_col="doc_id", text_col="text"):
    """Add ``lang_pred`` and ``score`` (probability of it) to every row; columns of these names are replaced.

    A null text, one without a letter, and any text under a model without languages is
    ``und`` with score 0. Ties go to the first language in the alphabet.
    """
    langs, idf, t = model["langs"], model["idf"], model["t"]
    weights = np.ascontiguousarray(model["weights"].T)
    shared = docs.sparkSession.sparkContext.broadcast((langs, idf, weights, t))

    def run(batches):
        langs, idf, weights, t = shared.value
        for batch in sliced(batches):
            found = []
            for text in batch[text_col]:
                if not langs or text is None or not has_letter(text):
                    found.append((UNKNOWN, 0.0))
                    continue
                at, x = vector(text, idf)
                p = softmax((x @ weights[at]) / t)
                best = int(p.argmax())
                found.append((langs[best], float(p[best])))
            yield batch.assign(lang_pred=[f[0] for f in found], score=[f[1] for f in found])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    return docs.select(*kept).mapInPandas(run, ", ".join([*fields, "lang_pred string, score double"]))


def held_out(id_col="doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
    return F.coalesce(fold == 2, F.lit(False))


def learnable(docs, id_col="doc_id", text_col="text", lang_col="lang"):
    """Rows to learn from: an id that is not held out, a text, and a language."""
    return docs.where(
        F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col)
    ).select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
