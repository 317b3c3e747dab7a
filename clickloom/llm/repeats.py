"""Exact repeats of a fixed width, for sequences of 64-bit symbols: words or bytes of a text.

A window is ``width`` symbols in a row. It is removed if its content starts earlier too, in a document of smaller id
or earlier in the same one. Every window is given to one anchor: among its spans of ``seed`` symbols the one of least
hash, the first of equals. Equal windows have equal anchors at equal places, so windows need comparing only where
anchors agree. The windows of one anchor start next to each other; the symbols they cover are the anchor's context.

1. Anchors are counted over all documents. Those seen twice or more go into a Bloom filter of bounded size; what it
   lets through by chance costs rows, never results.
2. Of the anchors that pass, each document reports its first of every (anchor, context). Contexts are counted; every
   document but the first loses all windows of a context it shares. Later equals within a document are found locally.
3. Where an anchor has several contexts, their windows may still agree in part. One row per such context, with its
   text, goes to a collection of neighbours in the order of anchors; the caller's ``compare`` finds equal windows
   there. An anchor with more than CHUNK contexts is dealt over several collections, each of which then reports the
   first of its equal windows, and a partial aggregate over the windows' hashes settles the rest.
4. Removed stretches meet their document by one join.

Rows of the same id don't remove each other's windows; a null id is the least id. Anchors and contexts are told
apart by 64 bits each, windows across collections by 128.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.hashing import Spans, U, mix, sliding_min
from clickloom.sources.stage import stage

NO_ID = -(1 << 63)
CHUNK = 2048
COLLECTION = 4096
# Symbols of a text handled at a time; a place within fits into PLACE_BITS.
PLACE_BITS = 22
STRETCH = 1 << 18
# Symbols of short texts handled at a time.
AT_ONCE = 1 << 16
BLOOM_BITS = 1 << 28
PROBES = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9))


@dataclass(frozen=True)
class Anchors:
    """Parallel arrays: number of the sequence, anchor hash, context hash, first and last window start."""

    owner: np.ndarray
    key: np.ndarray
    context: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def __len__(self) -> int:
        return len(self.key)

    def take(self, at: np.ndarray) -> Anchors:
        return Anchors(*(getattr(self, f)[at] for f in FIELDS))


FIELDS = ("owner", "key", "context", "first", "last")


def anchors(sequences: list[np.ndarray], width: int, seed: int) -> Anchors:
    """Anchors of whole sequences, left to right. Many short ones are laid end to end and handled at once; a long one
    is handled in stretches. What a window's anchor is follows from nothing but the window, so equal windows meet."""
    parts: list[Anchors] = []
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0
    for owner, symbols in enumerate(sequences):
        for begin in range(0, len(symbols) - width + 1, STRETCH):
            held.append((owner, begin, symbols[begin : begin + STRETCH + width - 1]))
            size += len(held[-1][2])
            if size >= AT_ONCE:
                parts.append(anchors_of_pieces(held, width, seed))
                held, size = [], 0
    if held:
        parts.append(anchors_of_pieces(held, width, seed))
    if not parts:
        none = np.empty(0, np.int64)
        return Anchors(none, none.astype(np.uint64), none.astype(np.uint64), none, none)
    return Anchors(*(np.concatenate([getattr(p, f) for p in parts]) for f in FIELDS))


def anchors_of_pieces(pieces: list[tuple[int, int, np.ndarray]], width: int, seed: int) -> Anchors:
    lengths = np.array([len(p) for _, _, p in pieces])
    ends = np.cumsum(lengths)
    begins = ends - lengths
    spans = Spans(np.concatenate([p for _, _, p in pieces]))
    seeds = spans.rolling(seed, mixed=False)
    keep = U((1 << PLACE_BITS) - 1)
    least = sliding_min((seeds & ~keep) | np.arange(len(seeds), dtype=np.uint64), width - seed + 1)
    place = (least & keep).astype(np.int64)
    # Windows that run over the end of their piece count with no anchor.
    for end in ends[:-1].tolist():
        place[end - width + 1 : end] = -1
    cut = np.empty(len(place), bool)
    cut[0] = True
    np.not_equal(place[1:], place[:-1], out=cut[1:])
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(place)) - 1
    place = place[first]
    real = place >= 0
    first, last, place = first[real], last[real], place[real]
    context = mix(spans.hash(first, last + width) ^ ((place - first).astype(np.uint64) << U(7)))
    piece = np.searchsorted(ends, first, "right")
    shift = np.array([b for _, b, _ in pieces])[piece] - begins[piece]
    return Anchors(np.array([o for o, _, _ in pieces])[piece], mix(seeds[place]), context, first + shift, last + shift)


def first_of_equals(found: Anchors) -> np.ndarray:
    """True where no equal (anchor, context) of the same sequence stands to the left."""
    out = np.zeros(len(found), bool)
    same = mix(found.key ^ (found.context * U(3))) ^ (found.owner.astype(np.uint64) * U(0x9E3779B97F4A7C15))
    out[np.unique(same, return_index=True)[1]] = True
    return out


class Bloom:
    """Bit table with three probes; may say yes by chance, never no wrongly."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.shift = U(64 - (len(words) * 64 - 1).bit_length())

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for probe in PROBES:
            bit = (keys * probe) >> self.shift
            out &= (self.words[bit >> U(6)] >> (bit & U(63)) & U(1)).astype(bool)
        return out


def build_bloom(keys: DataFrame, count: int, limit: int = BLOOM_BITS) -> Bloom:
    """Filter of a stored long column ``key``: 32 bits a key, ``limit`` bits at most. Spark sets the bits."""
    bits = min(limit, max(1 << 12, 1 << (32 * count - 1).bit_length()))
    shift = U(64 - (bits - 1).bit_length())

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            bit = np.concatenate([(key * probe) >> shift for probe in PROBES])
            yield pa.RecordBatch.from_arrays([pa.array((bit >> U(6)).astype(np.int32)), signed(U(1) << (bit & U(63)))], ["word", "bit"])

    words = np.zeros(bits // 64, np.uint64)
    if count:
        table = keys.select("key").mapInArrow(places, "word int, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        words[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return Bloom(words)


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64))


@dataclass(frozen=True)
class Repeats:
    """How texts become symbols and how a collection is compared.

    ``symbols(texts)`` gives the 64-bit symbols of each text; ``content(text, starts, ends)`` the bytes of spans of symbols;
    ``compare(contents)`` takes the contents of a collection, in the order of their documents, and gives parallel arrays
    (content, window start, class): windows of equal content share a class. A symbol takes ``symbol_bytes`` of a content.
    """

    width: int
    seed: int
    symbols: Callable[[list[str | None]], list[np.ndarray]]
    content: Callable[[str, np.ndarray, np.ndarray], list[bytes]]
    compare: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]
    symbol_bytes: int

    def of(self, texts: list[str | None]) -> Anchors:
        return anchors(self.symbols(texts), self.width, self.seed)

    def removed(self, docs: DataFrame, bloom_bits: int = BLOOM_BITS) -> DataFrame:
        """(id, mark, first, last): stretches of removed window starts, but for those that ``local`` finds.

        ``docs`` has id (long, not null) and text; ``mark`` is the text's checksum, so that rows which share an id but
        not the text keep their own stretches.
        """
        spark = docs.sparkSession
        op = self

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for texts in in_parts(batch.column("text")):
                    yield pa.RecordBatch.from_arrays([signed(op.of(texts).key)], ["key"])

        counted = docs.select("text").mapInArrow(keys, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        repeated = stage(counted.where("n > 1").select("key"), "rep-keys")
        known = spark.sparkContext.broadcast(build_bloom(repeated, repeated.count(), bloom_bits))

        def reports(batches: Iterator[pa.RecordBatch], pick: Callable, content: bool) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for ids, texts in zip(in_parts(batch.column("id")), in_parts(batch.column("text")), strict=True):
                    found = op.of(texts)
                    found = found.take(np.flatnonzero(first_of_equals(found)))
                    owners = np.array(ids, np.int64)[found.owner]
                    met = np.flatnonzero(pick(found, owners))
                    found, owners = found.take(met), owners[met]
                    marks = np.array([mark_of(t) for t in texts], np.int32)[found.owner]
                    columns = [signed(found.key), signed(found.context), pa.array(owners), pa.array(marks),
                               pa.array(found.first.astype(np.int32)), pa.array(found.last.astype(np.int32))]
                    names = ["key", "context", "id", "mark", "first", "last"]
                    if content:
                        ends = np.searchsorted(found.owner, np.arange(len(texts) + 1))
                        contents = []
                        for k in np.unique(found.owner).tolist():
                            mine = slice(ends[k], ends[k + 1])
                            contents += op.content(texts[k], found.first[mine], found.last[mine] + op.width)
                        columns.append(pa.array(contents, pa.binary()))
                        names.append("content")
                    yield pa.RecordBatch.from_arrays(columns, names)

        def met_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return reports(batches, lambda found, _: known.value.has(found.key), False)

        schema = "key long, context long, id long, mark int, first int, last int"
        met = stage(docs.mapInArrow(met_again, schema), "rep-met")
        classes = stage(met.groupBy("key", "context").agg(F.min("id").alias("least")), "rep-classes")
        shared = classes.withColumnsRenamed({"key": "k", "context": "c"})
        whole = met.join(shared, F.expr("key = k AND context = c AND id > least")).select("id", "mark", "first", "last")

        # Anchors of several contexts: the first bearer of each context shows its symbols.
        several = stage(classes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("key", "s"), "rep-several")

        def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                key, context, least = (batch.column(c).to_numpy().view(np.uint64) for c in ("key", "context", "least"))
                yield pa.RecordBatch.from_arrays([signed(triple(key, context, least))], ["key"])

        firsts = stage(classes.join(several, F.expr("key = s")).select("key", "context", "least"), "rep-firsts")
        wanted = stage(firsts.mapInArrow(triples, "key long"), "rep-wanted")
        asked = spark.sparkContext.broadcast(build_bloom(wanted, wanted.count(), bloom_bits))

        def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pick = lambda found, ids: asked.value.has(triple(found.key, found.context, ids.view(np.uint64)))
            return reports(batches, pick, True)

        # What the filter lets through by chance goes here, so that a collection holds one bearer of a context.
        bearers = firsts.withColumnsRenamed({"key": "fk", "context": "fc"})
        texts = docs.mapInArrow(shown, schema + ", content binary").join(
            bearers, F.expr("key = fk AND context = fc AND id = least"), "left_semi")
        hot = stage(several.where(F.col("n") > CHUNK).select("s", F.ceil(F.col("n") / CHUNK).alias("parts")), "rep-hot")
        dealt = texts.join(hot, F.expr("key = s"), "left").withColumns({
            "parts": F.coalesce("parts", F.lit(1)), "part": F.coalesce(F.pmod("context", "parts"), F.lit(0)).cast("int"),
        })

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in collections(batches):
                yield op.settle(rows)

        settled = stage(
            dealt.select("key", "part", "parts", "id", "mark", "first", "content").repartition("key", "part")
            .sortWithinPartitions("key", "part").mapInArrow(compare, "id long, mark int, first int, last int, a long, b long"),
            "rep-settled",
        )
        here = settled.where("a IS NULL").select("id", "mark", "first", "last")
        # First windows of each collection, where an anchor was dealt over several.
        left = settled.where("a IS NOT NULL")
        least = left.groupBy(F.col("a").alias("la"), F.col("b").alias("lb")).agg(F.min("id").alias("least"))
        own = left.groupBy(F.col("a").alias("oa"), F.col("b").alias("ob"), F.col("id").alias("oi"), F.col("mark").alias("om")).agg(F.min("first").alias("start"))
        across = (
            left.join(stage(least, "rep-least"), F.expr("a = la AND b = lb"))
            .join(stage(own, "rep-own"), F.expr("a = oa AND b = ob AND id = oi AND mark = om"))
            .where("id > least OR first > start").select("id", "mark", "first", "last")
        )
        return whole.unionByName(here).unionByName(across)

    def settle(self, rows: pa.Table) -> pa.RecordBatch:
        """Removed stretches of a collection, and the windows of dealt anchors that are left, with their hashes."""
        ids, marks, firsts = (rows.column(c).to_numpy() for c in ("id", "mark", "first"))
        contents = rows.column("content").to_pylist()
        order = np.lexsort((firsts, marks, ids))
        which, start, kind = self.compare([contents[i] for i in order])
        which = order[which]
        place = firsts[which] + start
        # Within a class: the least id, and of each row of it the first start.
        by = np.lexsort((place, marks[which], ids[which], kind))
        which, start, kind, place = which[by], start[by], kind[by], place[by]
        new = np.diff(kind, prepend=-1) != 0
        least = ids[which][np.flatnonzero(new)][np.cumsum(new) - 1]
        same = (kind[1:] == kind[:-1]) & (ids[which][1:] == ids[which][:-1]) & (marks[which][1:] == marks[which][:-1])
        run = np.cumsum(~np.concatenate([[False], same])) - 1
        head = place[np.flatnonzero(~np.concatenate([[False], same]))][run] if len(place) else place
        gone = (ids[which] > least) | (place > head)
        out = np.lexsort((start[gone], which[gone]))
        w, p = which[gone][out], place[gone][out]
        cut = (np.diff(w, prepend=-1) != 0) | (np.diff(p, prepend=-2) != 1)
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(p)) - 1 if len(begin) else begin
        parts = rows.column("parts").to_numpy()
        open_ = np.flatnonzero(~gone & (parts[which] > 1))
        hashes = [window_hash(contents[which[i]], int(start[i]), self.symbol_bytes * self.width, self.symbol_bytes) for i in open_]
        a, b = (np.array([h[x] for h in hashes], np.uint64) for x in (0, 1))
        nothing = pa.nulls(len(begin), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([ids[w[begin]], ids[which[open_]]])), pa.array(np.concatenate([marks[w[begin]], marks[which[open_]]])),
                pa.array(np.concatenate([p[begin], place[open_]]).astype(np.int32)), pa.array(np.concatenate([p[end], place[open_]]).astype(np.int32)),
                pa.concat_arrays([nothing, signed(a)]), pa.concat_arrays([nothing, signed(b)]),
            ],
            ["id", "mark", "first", "last", "a", "b"],
        )

    def covered(self, texts: list[str | None], counts: list[int], stretches: list) -> list[np.ndarray]:
        """For each text, True for each of its symbols (``counts`` of them) that a removed window covers."""
        found = self.of(texts)
        again = found.take(np.flatnonzero(~first_of_equals(found)))
        bounds = np.searchsorted(again.owner, np.arange(len(texts) + 1))
        out = []
        for k, (n, some) in enumerate(zip(counts, stretches, strict=True)):
            mine = slice(bounds[k], bounds[k + 1])
            first, last = again.first[mine], again.last[mine]
            if some:
                pairs = np.array([(s["first"], s["last"]) for s in some])
                first, last = np.concatenate([first, pairs[:, 0]]), np.concatenate([last, pairs[:, 1]])
            if not len(first):
                out.append(np.zeros(n, bool))
                continue
            step = np.bincount(first, minlength=n + 1) - np.bincount(last + self.width, minlength=n + 1)
            out.append(np.cumsum(step)[:n] > 0)
        return out

    def with_stretches(self, docs: DataFrame, bloom_bits: int = BLOOM_BITS) -> DataFrame:
        """``docs`` (id, text) with a column ``stretches``: the removed window starts of each row, null if none."""
        found = self.removed(docs.where("id IS NOT NULL"), bloom_bits)
        by_row = found.groupBy(F.col("id").alias("i"), F.col("mark").alias("m")).agg(F.collect_list(F.struct("first", "last")).alias("stretches"))
        mark = (F.crc32(F.coalesce("text", F.lit("")).cast("binary")) - F.lit(1 << 31)).cast("int")
        return docs.join(stage(by_row, "rep-stretches"), (F.col("id") == F.col("i")) & (mark == F.col("m")), "left").drop("i", "m")


def in_parts(column: pa.Array, rows: int = 256) -> Iterator[list]:
    """Values of an Arrow column, some at a time."""
    for start in range(0, len(column), rows):
        yield column.slice(start, rows).to_pylist()


def triple(key: np.ndarray, context: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix(mix(key ^ mix(context)) ^ mix(doc))


def window_hash(content: bytes, start: int, size: int, step: int) -> tuple[int, int]:
    digest = hashlib.blake2b(content[start * step : start * step + size], digest_size=16).digest()
    return int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")


def collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by key and part, about COLLECTION at a time, no (key, part) torn."""
    held: list[pa.RecordBatch] = []
    size = 0
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, part = batch.column("key").to_numpy(), batch.column("part").to_numpy()
        begin = 0
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        for at in [0, *cuts.tolist()]:
            if size + at - begin >= COLLECTION and (at or (key[0], part[0]) != last):
                if at > begin:
                    held.append(batch.slice(begin, at - begin))
                yield pa.Table.from_batches(held)
                held, size, begin = [], 0, at
        held.append(batch.slice(begin))
        size += batch.num_rows - begin
        last = (key[-1], part[-1])
    if held:
        yield pa.Table.from_batches(held)


def mark_of(text: str | None) -> int:
    return zlib.crc32((text or "").encode("utf-8")) - (1 << 31)
