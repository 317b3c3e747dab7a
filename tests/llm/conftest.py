import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, n long, component string, size int"


def words(rng, n):
    return " ".join(rng.choice(["salt", "moor", "tide", "lark", "fern", "Crag", "dune,", "rill.", "öde", "wold"]) + str(rng.randint(0, 400)) for _ in range(n))


def corpus():
    """Documents with nulls, empty and long texts, exact and near copies, shared passages, ties and odd characters."""
    rng = random.Random(3)
    passage, other = words(rng, 60), words(rng, 45)
    base = words(rng, 150)
    texts = [None, "", "   \n\t", "x", "a b", "one two three", words(rng, 40), passage, f"{words(rng, 30)} {passage} {words(rng, 12)}"]
    texts += [f"{passage}\n{words(rng, 25)}\n{other}", f"{other} {words(rng, 9)} {passage}", base, base, base + " end"]
    for k in range(12):  # near copies, each a little further from the first
        cells = base.split()
        for _ in range(1 + k):
            cells[rng.randrange(len(cells))] = f"new{rng.randint(0, 99)}"
        texts.append(" ".join(cells))
    texts += ["tick " * 700, "tock tick " * 300, "é" * 400, "\U0001f600 " * 80, words(rng, 6000) + " " + passage, "\0\x1c\x1d odd \x85\xa0 spaces  ", "ΑΣ Σ İ ﬁ"]
    texts += [words(rng, 80) for _ in range(20)] + [words(rng, 20) + " " + other[:160] + words(rng, 3) for _ in range(6)]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i * 3, t, [None, "en", "de"][i % 3], [None, "b", "a", "", "é"][i % 5], None, 1, "k", None, "c", i))
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from clickloom.session import ship

    return ship(spark).createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def pairs(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.fixture(scope="session")
def empty(spark, docs):
    return spark.createDataFrame([], SCHEMA)
