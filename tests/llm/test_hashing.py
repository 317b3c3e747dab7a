"""Hashes must tell apart what patterns make collide modulo 2^64."""

import brute
import numpy as np
import pytest

from clickloom.llm import hashing, minhash, substring_dedup, suffix_dedup
from clickloom.session import ship


def thue_morse(n: int, letters: str = "ab") -> str:
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_spans_equal_a_plain_polynomial():
    rng = np.random.default_rng(4)
    symbols = rng.integers(0, 1 << 64, 90, dtype=np.uint64)
    spans, p = hashing.Spans(symbols), int(hashing.PRIME)
    starts = rng.integers(0, 60, 200)
    ends = starts + rng.integers(0, 30, 200)
    want = {}
    for a, b, got in zip(starts.tolist(), ends.tolist(), spans.hash(starts, ends).tolist(), strict=True):
        key = (b - a, *(sum(((int(s) >> shift) & p) * pow(base, k, p) for k, s in enumerate(symbols[a:b])) % p
                        for base, shift in zip(hashing.BASES, (0, 31), strict=True)))
        assert want.setdefault(key, got) == got
    assert len(set(want.values())) == len(want)


def test_residues():
    values = np.array([0, 1, (1 << 31) - 1, 1 << 31, (1 << 62) - 1, (1 << 64) - 1, 12345678901234567890], np.uint64)
    assert hashing.residue(values).tolist() == [int(v) % ((1 << 31) - 1) for v in values]


def test_long_texts_have_their_own_powers():
    symbols = np.random.default_rng(1).integers(0, 1 << 64, 70_000, dtype=np.uint64)
    long = hashing.Spans(np.concatenate([symbols, symbols])).hash(np.array([0, 70_000]), np.array([70_000, 140_000]))
    assert long[0] == long[1] == hashing.Spans(symbols).hash(np.array([0]), np.array([70_000]))[0]


@pytest.mark.parametrize("made", ["letters", "words"])
def test_patterns_of_two_letters_or_words(spark, made):
    """A Thue-Morse sequence and its complement, as one word each and as sequences of two words."""
    one, two = thue_morse(1024), thue_morse(1024, "ba")
    if made == "letters":
        lead = [f"w{i}" for i in range(19)]
        texts = [one, two, " ".join([*lead, one]), " ".join([*lead, two])]
    else:
        texts = [" ".join(f"{c}lpha" for c in one), " ".join(f"{c}lpha" for c in two)]
    pairs = list(enumerate(texts, 1))
    docs = ship(spark).createDataFrame(pairs, "doc_id long, text string")
    near = {r["id"]: (r["n_shingles"], r["component"]) for r in minhash.near_duplicates(docs, width=3, percent=85).collect()}
    assert near == brute.near(pairs, 3, 85)
    words = {r["id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.kept_words(docs, 20, hashed=True).collect()}
    assert words == brute.word_dedup(pairs)
    data = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.digests(docs, 100).collect()}
    assert data == brute.byte_dedup(pairs)
