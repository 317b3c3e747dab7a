"""Lexical search, spelling variants and packing against brute force and the tokenizers library."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import lexical_search, packing, spelling
from clickloom.llm.queries import byte_vocabulary
from clickloom.session import ship

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_search(docs, items, k=10):
    tf = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    n_docs, length = len(tf), sum(c.total() for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        asked = set(TERM.findall((text or "").translate(LOWER)))
        found = []
        for i, c in tf:
            m = 100 - 90 + 90 * c.total() * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                found.append((-score, i is not None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k])]
    return out


def shown(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


ITEMS = [(1, "salt1 moor2 TIDE3 fern4 lark5, wold6"), (2, ""), (3, None), (4, "nowhere met"), (5, "x one two"), (5, "tick tock new1"),
         (None, "σ ﬁ öde0 öde1 öde2 öde3 rill.1"), (6, " ".join(f"{w}{i}" for w in ("salt", "moor", "Crag") for i in range(60)))]


@pytest.mark.parametrize("trie, block", [(1 << 14, 1 << 22), (7, 200)])
def test_search_equals_brute_force(spark, docs, pairs, monkeypatch, trie, block):
    monkeypatch.setattr(lexical_search, "TRIE", trie)
    monkeypatch.setattr(lexical_search, "BUCKET", 2)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = lexical_search.search(docs, items, block_bytes=block)
    assert shown(got, "item_id", "rank", "id", "score") == sorted(brute_search(pairs, ITEMS), key=str)


def test_search_with_copies_null_ids_and_ties(spark):
    rows = [(None, "apple pear"), (7, "apple pear"), (7, "apple pear"), (3, "apple pear"), (9, "pear"), (10, "plum"), (11, ""), (12, None)]
    rows += [(100 + i, f"apple word{i % 3}") for i in range(40)]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "apple pear"), (2, "word1 plum")], "item_id long, text string")
    want = sorted(brute_search(rows, [(1, "apple pear"), (2, "word1 plum")]), key=str)
    assert shown(lexical_search.search(docs, items), "item_id", "rank", "id", "score") == want


def test_bounds_hold_for_all_below(spark, pairs):
    """Every node's bound is at least each score below it; the search leaves branches out."""
    rng = np.random.default_rng(3)
    ranks = [np.sort(rng.choice(40, rng.integers(1, 12), replace=False)) for _ in range(300)]
    tfs = [rng.integers(1, 9, len(r)) for r in ranks]
    trie = lexical_search.Trie(np.arange(300), rng.integers(10, 500, 300), ranks, tfs)
    weights = np.where(rng.random(40) < 0.3, rng.integers(1, 5000, 40), 0)

    def walk(node):
        for d in range(node.low, node.high):
            r, t = trie.ranks[trie.ends[d]:trie.ends[d + 1]], trie.tfs[trie.ends[d]:trie.ends[d + 1]]
            assert (weights[r] * (10**9 * t // (1000 * t + 8 * trie.m[d]))).sum() <= trie.bound(node, weights)
        assert not node.branches or [b for n in sorted(node.branches, key=lambda n: n.low) for b in (n.low, n.high)][0] == node.low
        for b in node.branches:
            walk(b)

    walk(trie.root)


def test_search_on_empty_tables(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(empty, items).count() == 0 and lexical_search.search(docs, items.limit(0)).count() == 0
    assert lexical_search.search(docs, items.where("item_id IN (2, 3)")).count() == 0


def brute_words(docs, least, noise):
    runs, counts = re.compile("[A-Za-zÀ-ÿ]+"), Counter()
    for i, text in docs:
        for run in runs.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= 2}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute_variants(words, factor=10):
    form = {}
    close = {w: [v for v in words if near(w, v)] for w in words}
    for w in words:
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= factor * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(close[w]), words.get(form[w])))
    return sorted(out, key=str)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def misspelt(seed=5):
    """Words in chains of variants, with repeated letters, ends cut, both scripts' letters, and long shared beginnings."""
    rng = random.Random(seed)
    base = ["harbour", "aaaaaaaa", "mississippi", "übergrößen", "straßenbahn", "internationalisation", "international", "lantern", "lanterns", "ÀÀÀÀÀÀÀ"]
    words = list(base)
    for _ in range(260):
        w = rng.choice(words)
        i = rng.randrange(len(w))
        words.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abxé") + w[i:], w[:i] + rng.choice("abxé") + w[i + 1 :], w + w[-1]]))
    return {w: n for w in words for n in [rng.choice([2, 2, 3, 20, 25, 200, 2500])]}


def test_variants_equal_brute_force(spark):
    words = misspelt()
    got = spelling.variants(ship(spark).createDataFrame(list(words.items()), "word string, n long").repartition(4))
    assert shown(got, *COLUMNS) == brute_variants(words)


@pytest.mark.parametrize("noise", [None, 3])
def test_words_and_variants_of_documents(spark, docs, pairs, noise):
    rows = [(i, f"{t or ''} Harbour harbour harbours; lantern lantern") for i, t in pairs] + [(None, "harbour harbour"), (4, None), (4, "HARBOUR"), (4, "HARBOUR")]
    made = ship(spark).createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, word string")
    words = brute_words(rows, 4, noise)
    got = spelling.variant_groups(made, least=4, noise=noise)
    assert shown(got, *COLUMNS) == brute_variants(words) and len(words) > 10


def test_no_words(spark, empty):
    assert spelling.variant_groups(empty).count() == 0
    one = spelling.variants(ship(spark).createDataFrame([("harbour", 3)], "word string, n long")).collect()
    assert [tuple(r) for r in one] == [("harbour", None, "harbour", 3, 0, None)]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_vocabulary())


ODD = [" leading", "trailing ", "two  spaces", "tab\t x", "line\n\n next", "a \n b", "\n", " ", "it's 'tis don't", "x<|endoftext|>y <|endoftext|> z",
       "nbsp  here 　 and", "emoji \U0001f600\U0001f600, ok", "1,234.5 3rd", "zero\0byte here", "wait... what?! (yes),", "Ünïcödé, ΑΣ. йод!", "\x1c a \x85 b"]


def test_encoder_equals_the_library(tokenizer, pairs):
    texts = [t for _, t in pairs] + ODD
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    encoder = packing.Encoder(byte_vocabulary())
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
    encoder.size = packing.MEMORY_BYTES + 1
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want


def test_pieces_hold_each_id_once(spark, docs, pairs, tokenizer):
    packer = packing.Packer(byte_vocabulary(), size=64)
    pieces = packer.pieces(docs)
    rows = pieces.collect()
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in pairs}
    total = sum(map(len, want.values()))
    got = {i: [] for i in want}
    for r in sorted(rows, key=lambda r: (r["id"], r["start"])):
        assert r["start"] == len(got[r["id"]]) and r["doc_tokens"] == len(want[r["id"]]) and len(r["ids"]) == 4 * r["length"] > 0
        got[r["id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    assert got == want
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(ends) == list(range(-(-total // 64))) and sorted(ends.values())[1:] == [64] * (len(ends) - 1)
    whole = {r["sequence_id"]: r for r in packer.sequences(pieces).collect()}
    assert all(whole[s]["length"] == n and len(whole[s]["ids"]) == 4 * n for s, n in ends.items())


def test_packing_repeated_and_missing_ids(spark, empty):
    packer = packing.Packer(byte_vocabulary())
    made = ship(spark).createDataFrame([(None, "a b"), (1, None), (1, "a b"), (1, "a b"), (2, "")], "doc_id long, text string")
    rows = packer.pieces(made).collect()
    assert len(rows) == 5 and sorted(r["doc_tokens"] for r in rows) == [1, 1, 3, 3, 3] and {r["sequence_id"] for r in rows} == {0}
    assert packer.pieces(empty).count() == 0


def test_curve_visits_neighbours():
    """Places in the order of their keys are all different and one step apart."""
    for dimensions, bits in ((2, 4), (3, 3), (4, 2)):
        side = 1 << bits
        points = np.stack(np.meshgrid(*[np.arange(side)] * dimensions), -1).reshape(-1, dimensions)
        keys = packing.hilbert(points, bits)
        assert sorted(keys.tolist()) == list(range(side**dimensions))
        assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_likeness_along_the_curve(spark, docs, pairs):
    """Neighbours on the curve share more words than documents in the order of ids."""
    rng = random.Random(2)
    topics = [[f"{t}{i}" for i in range(40)] for t in ("sea", "hill", "town", "wood", "farm", "mine")]
    rows = [(i, " ".join(rng.choices(topics[i % 6], k=80))) for i in range(240)]
    packer = packing.Packer(byte_vocabulary())
    made = ship(spark).createDataFrame(rows, "doc_id long, text string")
    encoded = packer.encoded(made)
    order = [r["id"] for r in encoded.join(packer.places(encoded), "row").orderBy("at").collect()]
    assert sum(a % 6 == b % 6 for a, b in zip(order, order[1:])) > 150
