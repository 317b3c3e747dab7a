"""The pipeline's stages, each judged on its own input."""

import hashlib
import re
import zlib

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm.queries import QUERIES, vocabulary
from clickloom.session import ship
from clickloom.sources.stage import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], SF), "test"))
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_names_and_columns(steps):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert all(s.columns == steps[0].columns for s in steps[:5])


def test_quality_keeps_good_documents(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r[0] for r in steps[1].select("doc_id").collect()}
    good = [r[0] in kept for r in labels.where("quality = 1").select("doc_id").collect()]
    bad = [r[0] in kept for r in labels.where("quality = 0").select("doc_id").collect()]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_near_dedup_keeps_one_of_each_group(steps):
    before = pairs(steps[1])
    want = {i for i, (_, c) in brute.near(before, 5, 80).items() if i == c}
    assert sorted(i for i, _ in pairs(steps[2])) == sorted(want)


def test_repeats_are_gone(steps):
    lost = brute.byte_dedup(pairs(steps[2]))
    after = dict(pairs(steps[3]))
    assert set(after) == set(lost)
    for i, text in pairs(steps[2]):
        assert (after[i] == text) == (lost[i][1] == 0)


def test_mix_meets_targets(steps):
    def sizes(df):
        out = {}
        for r in df.select("source", "text").collect():
            out[r["source"]] = out.get(r["source"], 0) + len(brute.WORD.findall(r["text"] or ""))
        return out

    before, after = sizes(steps[3]), sizes(steps[4])
    for source, target in brute.targets(before).items():
        assert abs(after.get(source, 0) - target) <= max(0.05 * target, 300)
    assert steps[4].groupBy("doc_id").count().where("count > 3").count() == 0


def test_encoding_decodes(steps):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    texts = dict(pairs(steps[4]))
    for r in steps[5].collect():
        assert r["ids"] == tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])


def test_ids_are_decoded_in_the_stage(steps):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    for r in steps[5].collect():
        decoded = tokenizer.decode(r["ids"], skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode("utf-8")).hexdigest()


def test_empty_documents(spark, steps):
    docs = steps[0].limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF)
        assert docs.count() == 0


# Queries whose rows are ranked places, words and pieces; their own tests follow.
OTHER_ROWS = {"op11_lexical_search", "op12_spelling_variants", "op13_packing"}


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - OTHER_ROWS))
def test_query_returns_every_row(spark, steps, name):
    table = {"op1": "embeddings", "op3": "pages"}.get(name.split("_")[0], "documents")
    key = {"embeddings": "vec_id", "pages": "page_id"}.get(table, "doc_id")
    got = QUERIES[name](spark, SF).select(key)
    assert got.exceptAll(spark.read.parquet(f"{SF}/{table}.parquet").select(key)).count() == 0
    assert got.agg(F.countDistinct(key)).first()[0] == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_every_item_has_its_ranks(spark, steps):
    rows = {}
    for r in QUERIES["op11_lexical_search"](spark, SF).collect():
        rows.setdefault(r["item_id"], []).append((r["rank"], -r["score"], r["doc_id"]))
    items = {r[0] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id").collect()}
    assert rows and rows.keys() <= items
    for places in rows.values():
        places.sort()
        assert [p[0] for p in places] == list(range(1, len(places) + 1)) and len(places) <= 10
        assert [p[1:] for p in places] == sorted(p[1:] for p in places)


def test_every_word_has_a_row(spark, steps):
    texts = pairs(steps[0])
    got = {r["word"]: r["n"] for r in QUERIES["op12_spelling_variants"](spark, SF).collect()}
    counts = {}
    for doc, text in texts:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            word = run.translate(brute.LOWER)
            h = zlib.crc32(f"{doc}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] = counts.get(word, 0) + 1
    assert got == {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_pieces_make_up_every_document(spark, steps):
    pieces, sequences = {}, {}
    for r in QUERIES["op13_packing"](spark, SF).collect():
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(d for d, _ in pieces) == sorted(r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    for parts, whole in [(v, k[1]) for k, v in pieces.items()] + [(v, None) for v in sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == whole if whole is not None else at <= 2048
