"""Word and byte dedup against brute force."""

import dataclasses
import random

import brute
import numpy as np
import pytest

from clickloom.llm import repeats, substring_dedup, suffix_dedup


def by_id(df, *names):
    return {r["id"]: tuple(r[n] for n in names) for r in df.collect()}


def word_rows(docs, **options):
    return by_id(substring_dedup.kept_words(docs, 20, hashed=True, **options), "n_words", "n_removed", "kept")


def byte_rows(docs):
    return by_id(suffix_dedup.digests(docs, 100), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_words_equal_brute_force(docs, pairs):
    assert word_rows(docs) == brute.word_dedup(pairs)


def test_bytes_equal_brute_force(docs, pairs):
    assert byte_rows(docs) == brute.byte_dedup(pairs)


@pytest.mark.parametrize("chunk", [2, 7])
def test_anchors_dealt_over_collections_give_the_same(docs, pairs, monkeypatch, chunk):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    monkeypatch.setattr(repeats, "COLLECTION", 5)
    assert word_rows(docs) == brute.word_dedup(pairs)
    assert byte_rows(docs) == brute.byte_dedup(pairs)


def test_a_collection_holds_one_bearer_of_a_context(docs):
    op = suffix_dedup.byte_repeats(100)
    rows = suffix_dedup.prepared(docs, "doc_id", "text")

    def checked(contents):
        assert len(set(contents)) == len(contents), "a context was shown twice"
        return op.compare(contents)

    # A filter of 64 words is full, so every bearer passes it.
    strict = dataclasses.replace(op, compare=checked)
    assert strict.removed(rows, bloom_bits=1 << 12).count() > 0


def test_bloom_filter_keeps_its_bound(spark, docs):
    keys = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 50_000)
    frame = spark.createDataFrame([(int(k),) for k in keys], "key long")
    small = repeats.build_bloom(frame, len(keys), 1 << 12)
    assert small.words.nbytes == (1 << 12) // 8 and small.has(keys.view(np.uint64)).all()
    free = repeats.build_bloom(frame, len(keys))
    assert free.words.nbytes <= repeats.BLOOM_BITS // 8 and free.has(keys.view(np.uint64)).all()
    other = np.random.default_rng(2).integers(-(1 << 63), 1 << 63, 50_000).view(np.uint64)
    assert free.has(other).mean() < 0.01


def test_full_bloom_filter_changes_nothing(docs, pairs):
    op = substring_dedup.word_repeats(20)
    small = op.removed(suffix_dedup.prepared(docs, "doc_id", "text"), bloom_bits=1 << 12).count()
    assert small >= op.removed(suffix_dedup.prepared(docs, "doc_id", "text")).count()


def test_long_texts_in_stretches(monkeypatch):
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    whole = repeats.anchors([symbols], 20, 6)
    monkeypatch.setattr(repeats, "STRETCH", 100)
    for at_once in (50, 1 << 16):
        monkeypatch.setattr(repeats, "AT_ONCE", at_once)
        parts = repeats.anchors([symbols[:10], symbols, symbols[:20], symbols[5:]], 20, 6)
        mine = parts.take(np.flatnonzero(parts.owner == 1))
        assert mine.first[0] == 0 and mine.last[-1] == 880 and set(whole.key) == set(mine.key)
        assert (mine.first[1:] == mine.last[:-1] + 1).all()
        assert set(parts.owner.tolist()) == {1, 2, 3} and set(parts.key) == set(whole.key)


def test_repeated_rows_and_nulls(spark, docs, empty):
    text = " ".join(f"w{i}" for i in range(50))
    rows = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text), (3, None)], "doc_id long, text string")
    got = sorted((r["id"] is not None, r["id"] or 0, r["n_removed"]) for r in substring_dedup.kept_words(rows).collect())
    assert got == [(False, 0, 0), (True, 1, 50), (True, 1, 50), (True, 2, 50), (True, 3, 0)]
    assert substring_dedup.kept_words(empty).count() == 0
    assert suffix_dedup.digests(empty).count() == 0
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_texts_without_repeats_keep_columns(docs, pairs):
    cut = suffix_dedup.without_repeats(docs)
    assert cut.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert len(got) == len(pairs) and got[0] is None
    lost = {i: v[1] for i, v in brute.byte_dedup(pairs).items()}
    for i, text in pairs:
        if text is not None:
            assert len(text.encode()) - len(got[i].encode()) - lost[i] in range(0, 4 * 8)
            assert lost[i] or got[i] == text


def naive_order(strings):
    out = [(tuple(c + 1 for c in s[len(s) - n :]) + (0, i), i, n) for i, s in enumerate(strings) for n in range(len(s) + 1)]
    return sorted(out)


def test_column_wise_construction():
    rng = random.Random(5)
    for _ in range(60):
        strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 9))]
        owner, size, common = suffix_dedup.suffix_order(strings)
        naive = naive_order(strings)
        assert list(zip(owner.tolist(), size.tolist())) == [(i, n) for _, i, n in naive]
        for k in range(1, len(naive)):
            a, b = naive[k - 1], naive[k]
            x, y = strings[a[1]][len(strings[a[1]]) - a[2] :], strings[b[1]][len(strings[b[1]]) - b[2] :]
            n = next((p for p, (s, t) in enumerate(zip(x, y)) if s != t), min(len(x), len(y)))
            assert common[k] == n


def test_parse_gives_equal_windows_one_class():
    rng = random.Random(6)
    strings = [b"".join(bytes([rng.choice([1, 2])]) * 8 for _ in range(rng.randint(0, 30))) for _ in range(30)]
    which, start, kind = substring_dedup.parse(strings, 4)
    seen = {}
    for w, s, k in zip(which, start, kind):
        assert seen.setdefault(strings[w][s * 8 : s * 8 + 32], k) == k
    assert len(seen) == len(set(kind.tolist())) and len(kind) == sum(max(0, len(s) // 8 - 3) for s in strings)
