import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, score string, kept string"


@pytest.fixture(scope="session")
def corpus():
    """Rows with near and exact copies, shared passages, odd, null, empty and long texts."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 6))) for _ in range(80)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages, texts = [prose(25) for _ in range(4)], []
    for _ in range(150):
        kind = rng.random()
        if kind < 0.15 and texts:
            texts.append(rng.choice(texts))
        elif kind < 0.3 and texts:  # a near copy
            part = rng.choice(texts).split(" ")
            part[rng.randrange(len(part))] = "zzz"
            texts.append(" ".join(part))
        elif kind < 0.6:
            texts.append(f"{prose(rng.randint(0, 40))} {rng.choice(passages)[rng.randint(0, 30):]} {prose(rng.randint(0, 40))}")
        elif kind < 0.65:
            texts.append("ab" * rng.randint(10, 90))
        elif kind < 0.7:
            texts.append("é日" * rng.randint(10, 90) + prose(5))
        else:
            texts.append(prose(rng.randint(0, 120)))
    texts[3], texts[4], texts[5], texts[6] = None, "", "\n \t", prose(9000)
    rows = [(i * 3 % 1000, t) for i, t in enumerate(texts)]
    rows += [rows[10], rows[20]]  # repeated rows
    rng.shuffle(rows)
    return rows


@pytest.fixture
def docs(spark, corpus):
    """The rows with other columns, some null and some named like what operators use."""
    rows = [(i, t, "en" if i % 2 else None, None, None, "x", "y", None) for i, t in corpus]
    return spark.createDataFrame([*rows, (None, "no id at all here", "en", None, None, None, None, None)], SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
