"""BPE, language, quality, mixing, fingerprints and URL filters."""

import hashlib
import math
import random
import re

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import bpe, fingerprint, language, mixing, quality, url_filter
from clickloom.llm.common import crc_fold, fold_of
from clickloom.llm.queries import vocabulary


@pytest.fixture(scope="module")
def coder():
    return bpe.WordBpe(vocabulary())


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


ODD = ["", "a<|endoftext|>B <|startoftext|>", "ΑΣΣ Σ ΑΣ", "İstanbul ẞ ß", "a\u0301 e\x1c\x1d!\x1e! b\x85c\u2003d\u200b", "x" * 3000 + "ab" * 2000,
       "it's I'VE don't 123 ½ ²", "\U0001f600\U0001f468\u200d 日本語 ทดสอบ", "ŉ ǰ", "A\0B\x1fC", "'S 'T", "ﬁ ſ \u212a \u212b", "<|endoftext", "aaaaaaaaaaaaaaaa"]


def test_bpe_equals_the_library(coder, reference, pairs):
    texts = ODD + [t or "" for _, t in pairs]
    for text, ids in zip(texts, coder.encode_all(texts), strict=True):
        want = reference.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text[:40]
        assert coder.decode(ids) == reference.decode(want, skip_special_tokens=False)


def test_row_trees_equal_single_trees(coder):
    rng = random.Random(1)
    words = {"".join(rng.choice("thera noé") for _ in range(rng.randint(1, 60))).replace(" ", "") or "a" for _ in range(400)}
    coder.learn(words)
    assert all(coder.memory[w] == coder.encode_word(w) for w in words)


def test_full_memory_is_emptied(coder, reference, monkeypatch, pairs):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 40)
    monkeypatch.setattr(bpe, "HELD_WORDS", 30)
    texts = [t or "" for _, t in pairs]
    for text, ids in zip(texts, coder.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids


def test_bpe_columns(docs, empty, pairs, reference):
    coded = bpe.Bpe(vocabulary())
    got = docs.select("doc_id", coded.digests().alias("d"), coded.ids().alias("ids")).withColumn("text2", coded.text("ids")).collect()
    texts = dict(pairs)
    for r in got:
        ids = reference.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["d"]["n_tokens"] == len(ids) and r["ids"] == ids
        assert r["d"]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["d"]["decoded_sha256"] == hashlib.sha256(r["text2"].encode()).hexdigest()
    assert empty.select(coded.digests().alias("d")).count() == 0


def test_folds(docs):
    assert all(r["f"] == crc_fold(r["doc_id"], 5) for r in docs.select("doc_id", fold_of("doc_id", 5).alias("f")).collect())


def test_language(spark, docs, empty):
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held", fold_of("doc_id", 5) == 0)
    model = language.fit(base.where("NOT held"))
    row = language.identify(base.where("held"), model).agg(F.avg((F.col("lang") == F.col("language.lang_pred")).cast("int"))).first()
    assert row[0] > 0.97
    odd = language.identify(docs, model).select("text", "language.*").collect()
    for r in odd:
        letters = any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    nothing = language.fit(empty)
    assert {r[0] for r in language.identify(docs, nothing).select("language.lang_pred").collect()} == {"und"}
    assert language.identify(empty, model).count() == 0


def test_quality(spark, docs, empty):
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held", fold_of("doc_id", 4) == 2)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(base.where("NOT held"), labels)
    scored = base.where("held").join(labels, "doc_id").select("quality", (model.column() >= 0.7).cast("int").alias("p")).collect()
    assert np.mean([r["quality"] == r["p"] for r in scored]) > 0.95
    assert all(0 <= r["s"] <= 1 for r in docs.select(model.column().alias("s")).collect())
    assert quality.keep_good(empty, model).count() == 0
    marks = docs.select("doc_id", F.lit(1).alias("quality"))
    assert {r["s"] for r in docs.select(quality.fit(docs, marks).column().alias("s")).collect()} == {1.0}
    none = quality.fit(empty, marks.limit(0))
    assert {r["s"] for r in docs.select(none.column().alias("s")).collect()} == {1.0}


def test_isotonic():
    steps, values = quality.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 3.0, 1.0, 4.0]), np.array([4, 4, 4, 4]))
    assert steps.tolist() == [0.1, 0.1, 0.2, 0.3, 0.4, 0.4] and (np.diff(values) >= 0).all() and values[0] == 0


def test_mixing(docs, empty, pairs, rows):
    source = {r[0]: r[3] for r in rows}
    size = {i: len(brute.WORD.findall(t or "")) for i, t in pairs}
    by_source = {}
    for i, n in size.items():
        by_source[source[i]] = by_source.get(source[i], 0) + n
    want, got = brute.targets(by_source), {}
    mixed = mixing.mix(docs)
    for r in mixed.collect():
        assert r["size"] == size[r["id"]] and r["source_size"] == by_source[r["source"]] and 0 <= r["copies"] <= 3
        assert r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["rate"] <= 3
        got[r["source"]] = got.get(r["source"], 0) + r["size"] * r["copies"]
    for s in want:
        assert abs(got[s] - want[s]) <= max(0.03 * want[s], 120)
    again = {r["id"]: r["copies"] for r in mixing.mix(docs).collect()}
    assert again == {r["id"]: r["copies"] for r in mixed.collect()}
    rows_out = mixing.taken(docs, mixed)
    assert rows_out.columns == docs.columns and rows_out.count() == sum(again.values())
    assert mixing.mix(empty).count() == 0


def test_mixing_rates_meet_targets_before_rounding(spark, docs):
    rng = random.Random(2)
    sizes = [("a", rng.randint(1, 3000)) for _ in range(300)] + [("b", rng.randint(1, 50)) for _ in range(900)] + [("c", 7)] * 2000
    frame = spark.createDataFrame(sizes, "source string, size long")
    solved = mixing.tilts(frame, mixing.source_targets(frame))
    for r in solved.collect():
        mine = np.array([n for s, n in sizes if s == r["source"]])
        rate = np.minimum(3, np.exp(r["theta"] * mine / r["typical"]))
        assert (rate * mine).sum() == pytest.approx(r["target"], rel=1e-6)


def test_mixing_with_very_long_documents(spark, docs):
    """One document in a hundred is very long; a source meets its target by a few words, whatever its share."""
    rng = random.Random(4)
    lengths = {"a": [rng.randint(5, 40) for _ in range(3960)] + [50_000] * 40, "b": [rng.randint(5, 200) for _ in range(3000)]}
    frame = spark.createDataFrame(
        [(i, "w " * n, s) for s in lengths for i, n in enumerate(lengths[s])], "doc_id long, text string, source string").repartition(4).cache()
    size = {s: sum(v) for s, v in lengths.items()}
    for share in (0.7, 0.8, 0.9, 1.1):
        first = share * size["a"]
        mixed = mixing.mix(frame, weights=(first, sum(size.values()) - first)).collect()
        assert len(mixed) == 7000 and all(0 <= r["copies"] <= 3 for r in mixed)
        for s in size:
            mine = [r for r in mixed if r["source"] == s]
            assert abs(sum(r["size"] * r["copies"] for r in mine) - mine[0]["target"]) <= 20
            long_ones = [r for r in mine if r["size"] == 50_000]
            assert abs(sum(r["copies"] - r["rate"] for r in long_ones)) <= 1
    frame.unpersist()


def test_mixing_repeated_rows(spark, docs):
    frame = spark.createDataFrame([(1, "a a a", "x")] * 3 + [(2, None, None), (None, "b", "x")], "doc_id long, text string, source string")
    mixed = mixing.mix(frame)
    assert {(r["id"], r["size"], r["rows"]) for r in mixed.collect()} == {(1, 3, 3), (2, 0, 1), (None, 1, 1)}
    kept = mixing.taken(frame, mixed)
    assert kept.where("doc_id = 1").count() % 3 == 0 and kept.where("doc_id = 2").count() == 1


def test_fingerprints(spark, docs, empty, pairs):
    pairs_ = fingerprint.edited_pairs(docs)
    frame = pairs_.withColumn("e", fingerprint.fingerprint(F.col("edited")))
    got = frame.select("*", fingerprint.likeness(F.col("fingerprint"), F.col("e")).alias("near")).collect()
    want, texts = brute.edited(pairs), dict(pairs)
    assert len(got) == len(pairs)
    by_print = {}
    for r in got:
        assert r["edited"] == want[r["id"]] and r["n_chars"] == len(texts[r["id"]] or "")
        assert 0 <= r["near"] <= 1 and (r["near"] == 1) == (r["edited"] == (texts[r["id"]] or ""))
        by_print.setdefault(r["fingerprint"], set()).add(texts[r["id"]] or "")
    assert all(len(v) == 1 for v in by_print.values()) and len(by_print) == len({t or "" for t in texts.values()})
    assert fingerprint.edited_pairs(empty).count() == 0
    one = spark.createDataFrame([(7, "abcdef", 1)], "doc_id long, text string, id int")
    assert [r["edited"] for r in fingerprint.edited_pairs(one).collect()] == ["abcabc"]
    ties = spark.createDataFrame([(None, "zz"), (1, "aaaa"), (1, "bbbb"), (1, "bbbb"), (2, None)], "doc_id long, text string")
    assert sorted(r["edited"] for r in fingerprint.edited_pairs(ties).collect()) == sorted(["za", "aabb", "bbbb", "bb", ""])


def test_pieces_make_up_the_text(spark, docs):
    row = docs.select(F.array_join(F.regexp_extract_all("text", F.lit(fingerprint.PARAGRAPH), 0), "").alias("t"), "text").where("text IS NOT NULL")
    assert row.where("t <> text").count() == 0


def test_fingerprints_are_the_trees_of_brute_force(spark, docs, pairs):
    long = "\u6f22\u5b57" * 3 + "".join(chr(0x4E00 + (i * i * 31 + i * 7) % 1500) for i in range(4000))
    texts = [t or "" for _, t in pairs] + [long, "no marks at all " * 50, "\u3002" * 30 + "a", "aaaa" * 500]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = frame.select("id", fingerprint.fingerprint(F.col("text")).alias("f"), fingerprint.pieces(F.col("text")).alias("p")).collect()
    for r in got:
        assert r["p"] == brute.paragraphs(texts[r["id"]]) and r["f"] == brute.fingerprint(texts[r["id"]])
    shown = [[h for s in brute.merkle(t)[1] for h in s] for t in texts]
    couples = [(i, i + 1) for i in range(len(texts) - 1)]
    prints = {r["id"]: r["f"] for r in got}
    likes = spark.createDataFrame([(i, prints[i], prints[j]) for i, j in couples], "id long, a string, b string")
    for r in likes.select("id", fingerprint.likeness(F.col("a"), F.col("b")).alias("near")).collect():
        x, y = set(shown[r["id"]]), set(shown[r["id"] + 1])
        equal = texts[r["id"]] == texts[r["id"] + 1]
        assert r["near"] == (1.0 if equal else 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0)


def test_one_inserted_letter_leaves_the_other_pieces(spark, docs):
    rng = random.Random(5)
    english = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(600))
    chinese = "".join(chr(0x4E00 + int(rng.paretovariate(0.8) * 7) % 3000) for _ in range(4000))
    sentences = "".join(chr(0x4E00 + rng.randrange(3000)) + ("\u3002" if i % 30 == 29 else "") for i in range(4000))
    rows = [(i, t, "x" + t) for i, t in enumerate((english, chinese, sentences))]
    frame = spark.createDataFrame(rows, "id int, a string, b string")
    near = [r[0] for r in frame.orderBy("id").select(fingerprint.likeness(fingerprint.fingerprint(F.col("a")), fingerprint.fingerprint(F.col("b")))).collect()]
    assert min(near) > 0.8


def test_differences_locate_edits(spark, docs):
    text = "".join(f"Sentence number {i} stands here. " for i in range(200))
    edited = text.replace("number 70 stands", "number seventy stands").replace("Sentence number 150 stands here. ", "")
    twice, swapped = text + text, "".join(reversed(brute.paragraphs(text)))
    rows = [(1, text, edited), (2, text, text), (3, None, ""), (4, "", text[:40]), (5, text, twice), (6, text, swapped), (1, text, edited), (None, text, edited), (7, None, edited)]
    frame = spark.createDataFrame(rows, "id long, a string, b string").withColumns({
        "fingerprint": fingerprint.fingerprint(F.col("a")), "edited_fingerprint": fingerprint.fingerprint(F.col("b")),
        "pair": F.lit("clash"), "side": F.lit("clash")})
    got = {}
    for r in fingerprint.differences(frame).collect():
        got.setdefault(r["id"], []).append((r["side"], r["section"], r["paragraph"], r["hash"]))

    def want(a, b):
        (ra, sa, _), (rb, sb, _) = brute.merkle(a or ""), brute.merkle(b or "")
        if ra == rb:
            return []
        out, opened = [], {}
        for side, mine, other in (("a", sa, sb), ("b", sb, sa)):
            opened[side] = [(k + 1, s) for k, s in enumerate(mine) if s not in other]
        for side, other in (("a", "b"), ("b", "a")):
            held = {h for _, s in opened[other] for h in s}
            for k, s in opened[side]:
                new = [(side, k, i + 1, h) for i, h in enumerate(s) if h not in held]
                out += new or [(side, k, None, None)]
        return out or [(None, None, None, None)]

    for i, a, b in {(r[0], r[1], r[2]) for r in rows}:
        assert sorted(got.get(i, []), key=str) == sorted(want(a, b), key=str)
    # The places name the edited sentences.
    at = spark.createDataFrame([(text, s, p) for side, s, p, _ in got[1] if side == "a" and p], "t string, s int, p int")
    named = "".join(r[0] for r in at.select(fingerprint.paragraph_at(F.col("t"), F.col("s"), F.col("p"))).collect())
    assert "70" in named and "150" in named and "Sentence number 20 " not in named
    assert spark.createDataFrame([("a", 9, 9)], "t string, s int, p int").select(fingerprint.paragraph_at(F.col("t"), F.col("s"), F.col("p"))).first()[0] is None


def test_fingerprints_of_rows_without_ids(spark, docs):
    texts = [None, "", "b" * 7, "aa", "aa", "cccc"] * 20
    frame = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    got = fingerprint.edited_pairs(frame)
    ordered = sorted(t or "" for t in texts)
    want = sorted(a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(ordered, ordered[1:] + ordered[:1]))
    assert sorted(r["edited"] for r in got.collect()) == want


def test_url_filter(spark, docs):
    urls = [None, "no scheme", "http://A.Example.ORG/es/x?y", "https://example.org/en/1#z", "ftp://sub.org/", "x://com/fr/1", "http://b.com/de/2",
            "http://notcom/de/2", "http://org", "http://cheappills.net/en/3", "http://", "http://ä.example.com:80/en/\n1", "a://b.com/fr/://c.org/"]
    urls += ["http://www.stonebridge.net/en/5"] * 3
    frame = spark.createDataFrame(
        [(i, u, "<title>Stone bridge stone bridge</title>", "h", "t") for i, u in enumerate(urls)], "page_id long, url string, html string, host string, token string"
    )
    got = {r["id"]: r for r in url_filter.judge(frame).collect()}
    assert len(got) == len(urls)
    assert [(got[i]["host"], got[i]["path"]) for i in (0, 1, 2, 8, 10)] == [("", ""), ("", ""), ("a.example.org", "/es/x"), ("org", ""), ("", "")]
    assert [got[i]["rule"] for i in range(len(urls))][:13] == [
        None, None, "example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", None, None, None, None, None, "com/fr/"]
    assert [got[i]["verdict"] for i in range(10)] == ["allow", "allow", "block", "block", "allow", "allow", "block", got[7]["verdict"], got[8]["verdict"], got[9]["verdict"]]
    assert {r["verdict"] for r in got.values()} == {"allow", "block"}
    assert url_filter.judge(frame.limit(0)).count() == 0


def test_viterbi():
    words = {"stone": -2.0, "bridge": -2.0, "ton": -3.0, "eb": -3.0, "s": -4.0}
    assert url_filter.split_words("stonebridge", list(words), list(words.values()), -8.0) == ["stone", "bridge"]
    assert url_filter.split_words("qq", [], [], -8.0) == ["qq"] and url_filter.split_words("", [], [], -8.0) == []


def brute_split(run, known, unknown):
    """Best value over all ways to cut a short run."""
    best = {0: 0.0}
    for end in range(1, len(run) + 1):
        best[end] = max(best[a] + known.get(run[a:end], unknown - 2.3 * (end - a)) for a in range(end))
    return best[len(run)]


def test_splits_are_the_likeliest():
    rng = random.Random(8)
    for _ in range(300):
        run = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
        known = {run[a:b]: -rng.uniform(1, 8) for a, b in [sorted(rng.sample(range(len(run) + 1), 2)) for _ in range(rng.randint(0, 6))]}
        got = url_filter.split_words(run, list(known), list(known.values()), -6.0)
        value = sum(known.get(p, -6.0 - 2.3 * len(p)) for p in got)
        assert "".join(got) == run and math.isclose(value, brute_split(run, known, -6.0))


def test_long_words_are_known(spark):
    long = "donaudampfschifffahrtsgesellschaft"
    rows = [(i, f"http://{long}kapitaen{i % 2}.net/", f"<title>{long} kapitaen</title>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    words = spark.createDataFrame([(long, 6), ("kapitaen", 6)], "word string, n long")
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host")).distinct()
    assert {tuple(r["tokens"]) for r in url_filter.segment(hosts, words).collect()} == {(long, "kapitaen", "#", "net")}


def test_naive_bayes_equals_plain_counts(spark):
    """Verdicts and scores against counting by hand, over tokens that the splitter gives."""
    rng = random.Random(4)
    names = ["redbarn", "bluebarn", "oldmill", "newmill", "barnmill"]
    rows = []
    for i in range(80):
        tail = rng.choice(["com/fr/", "com/de/", "org/", "net/", "net/de/", "io/"])
        dot, path = tail.split("/", 1)
        rows.append((i, f"https://{rng.choice(names)}.{dot}/{path}{rng.choice(['a', 'b', 'farm'])}/{rng.randint(1, 9)}", f"<title>{rng.choice(['red barn', 'old mill', 'blue barn'])}</title>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["id"]: r for r in url_filter.judge(pages).collect()}
    counts = {}
    for _, _, html in rows:
        for w in re.findall("[a-z]+", html[7:-8]):
            counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values())

    def cut(run):
        known = {w: math.log(n / total) for w, n in counts.items() if w in run}
        return url_filter.split_words(run, list(known), list(known.values()), -math.log(total) + 2.3)

    tokens, ruled = {}, {}
    for i, url, _ in rows:
        host, path = re.match("https://([^/]*)(.*)", url).groups()
        tokens[i] = [t for run in re.findall("[a-z]+", host) for t in cut(run)] + [("#" if t.isdigit() else t) for t in re.findall("[a-z]+|[0-9]+", path)]
        ruled[i] = "allow" if host.endswith(".org") or host.endswith(".com") and path.startswith("/fr/") else "block" if host.endswith(".com") and path.startswith("/de/") else None
    seen = {v: [t for i in tokens if ruled[i] == v for t in tokens[i]] for v in ("allow", "block")}
    n_words = len({t for some in tokens.values() for t in some})
    prior = math.log((sum(v == "block" for v in ruled.values()) + 1) / (sum(v == "allow" for v in ruled.values()) + 1))
    for i in tokens:
        if ruled[i]:
            assert got[i]["verdict"] == ruled[i] and got[i]["score"] is None
            continue
        score = prior + sum(math.log((seen["block"].count(t) + 1) / (len(seen["block"]) + n_words)) - math.log((seen["allow"].count(t) + 1) / (len(seen["allow"]) + n_words)) for t in tokens[i])
        assert abs(got[i]["score"] - score) < 1e-5 and got[i]["verdict"] == ("block" if score > 0 else "allow")
