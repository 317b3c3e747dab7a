"""Near duplicates of texts and vectors, and components, against brute force."""

import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import embedding_dedup, minhash
from clickloom.llm.components import connected_components


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_minhash_equals_brute_force(docs, pairs, width, percent):
    got = {r["id"]: (r["n_shingles"], r["component"]) for r in minhash.near_duplicates(docs, width, percent).collect()}
    assert got == brute.near(pairs, width, percent)


def test_minhash_in_cells_gives_the_same(docs, pairs, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 3)
    monkeypatch.setattr(minhash, "CHUNK_SHINGLES", 500)
    got = {r["id"]: (r["n_shingles"], r["component"]) for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert got == brute.near(pairs, 3, 85)


def test_estimate_is_close_to_the_truth():
    rng = np.random.default_rng(2)
    for share in (0.5, 0.8, 0.95):
        both = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
        own = int(4000 * (1 - share) / 2)
        a, b = np.unique(both[own:]), np.unique(both[: 4000 - own])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        packed = [np.frombuffer(minhash.pack(minhash.minima(x)), "<u8")[None] for x in (a, b)]
        assert abs(float(minhash.estimate(*packed)[0, 0]) - true) < 0.15


def test_minhash_odd_tables(spark, docs, empty):
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.keep_one(empty).count() == 0
    text = "the same words in every row of this small table here"
    rows = spark.createDataFrame([(4, text), (4, text), (2, text), (None, text), (9, None), (None, None)], "doc_id long, text string")
    kept = sorted((str(r["doc_id"]), r["text"]) for r in minhash.keep_one(rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())
    # Rows without an id can't be told apart and stay.
    assert kept == [("2", text), ("9", ""), ("None", ""), ("None", text)]


def vectors(rng, n):
    out = []
    centre = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(4)]
    for i in range(n):
        v = [x + rng.gauss(0, rng.choice([0.0, 0.1, 0.3, 0.45])) for x in rng.choice(centre)]
        out.append((i, v, rng.choice([1, 1, 2, None])))
    nan = float("nan")
    odd = [None, [0.0] * 16, [nan] * 16, [None] * 16, [math.inf] + [1.0] * 15, [], out[0][1], [x * 1e150 for x in out[0][1]], out[0][1][:8], out[0][1][:8]]
    return out + [(n + k, v, 1) for k, v in enumerate(odd)]


def test_vectors_equal_brute_force(spark, docs, monkeypatch):
    rows = vectors(random.Random(8), 160)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"id": F.lit("x"), "node": F.lit(1)})
    want = brute.vectors([r for r in rows], 0.93)
    assert sum(n for n, _ in want.values()) > 300
    for chunk in (256, 9):
        monkeypatch.setattr(embedding_dedup, "CHUNK", chunk)
        got = {r["id"]: (r["n_links"], r["component"]) for r in embedding_dedup.near_duplicates(frame).collect()}
        missed = [i for i in want if got[i] != want[i]]
        # A pair at the threshold meets in some table with probability 0.997.
        assert set(got) == set(want) and sum(want[i][0] - got[i][0] for i in missed) <= 0.01 * sum(n for n, _ in want.values())
        assert all(got[i][0] <= want[i][0] for i in want)


def test_no_vectors(spark, docs):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(frame).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(5, 5), (300, 299), (299, 300)]
    links += [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(60)]
    nodes = {n for pair in links for n in pair}
    want = brute.components(nodes, [p for p in links if p[0] != p[1]])
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(want[n] == c for n, c in got.items())
    assert {n for n in nodes if want[n] != n} <= set(got)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
