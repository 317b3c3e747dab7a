"""Packing documents into sequences along a space-filling curve.

A document's tokens are counted in hashed places, the vector is projected to a few dimensions by fixed random signs, and
the place of the result on a Hilbert curve is its key. Documents are ranked by that key, so those next to each other tend to
be alike, and are laid end to end in this order: token k of the stream is token ``k mod size`` of sequence ``k div size``.
All sequences are full but the last. Documents are cut where a sequence ends.

The ids are stored once; only (row, key, number of ids) is sorted, and a row learns its place by one join.

Defined results: a null or empty text has the end id alone. Rows are packed one by one, also those that share an id or have
none; equal keys are ordered by id (null first), then by row. An empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import functools
import gc
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.sources.stage import stage

PLACES, DIMENSIONS, BITS = 4096, 4, 10
# Bytes of remembered chunks and their ids in a Python worker; a full memory is emptied.
MEMORY_BYTES = 224 << 20
ENTRY_BYTES = 160
# Below it (Latin, Greek, Cyrillic) all versions of Unicode agree on what a letter is.
SETTLED = "\u0500"
ROWS = 256


class Encoder:
    """Ids of texts by the tokenizers library, each distinct chunk between single spaces encoded once.

    The vocabulary's words begin with at most one space and never run over the border of a space, or of a line break, that
    stands between two characters that are no white space, so texts are cut there. A text with other white space next to a
    space is encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.newline = self.whole(["\n"])[0]
        self.forget()

    def forget(self) -> None:
        # Chunks with a space before them, and without; None for those that need their surroundings.
        self.spaced: dict[str, bytes | None] = {"": None}
        self.bare: dict[str, bytes | None] = {"": None}
        self.size = 0

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def lines(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks without line breaks or white space at their ends, encoded as the lines of one text."""
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(chunks)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(ids == np.frombuffer(self.newline, "<u4")[0])
        if len(self.newline) != 4 or len(cuts) != len(chunks) - 1:
            return self.whole(chunks)
        data, ends = ids.tobytes(), [*(4 * cuts).tolist(), 4 * len(ids)]
        return [data[a:b] for a, b in zip([0, *(end + 4 for end in ends)], ends, strict=False)]

    def learn(self, spaced: set[str], bare: set[str]) -> None:
        """Remember chunks. One of several lines is put together from these, and a word with one mark behind it from the two."""
        joined: list[tuple[dict, str, list[str]]] = []
        plain: dict[str, set[str]] = {" ": set(), "": set()}
        again = [(" ", spaced), ("", bare)]
        while again:
            space, chunks = again.pop()
            memory = self.spaced if space else self.bare
            further: set[str] = set()
            words = plain[space]
            for chunk in chunks:
                if chunk.isalpha():
                    words.add(chunk)
                elif chunk[-1] in ",.;:!?" and chunk[:-1].isalpha() and (chunk.isascii() or max(chunk) < SETTLED):
                    joined.append((memory, chunk, [chunk[:-1], chunk[-1]]))
                    words.add(chunk[:-1])
                    plain[""].add(chunk[-1])
                elif chunk[0].isspace() or chunk[-1].isspace():
                    memory[chunk] = None
                elif "\n" in chunk:
                    parts = chunk.split("\n")
                    if any(not p or p[0].isspace() or p[-1].isspace() for p in parts):
                        memory[chunk] = None
                    else:
                        joined.append((memory, chunk, parts))
                        further.update(parts[1:])
                        again.append((space, {parts[0]}))
                else:
                    words.add(chunk)
            if further:
                again.append(("", further))
        for space, memory in ((" ", self.spaced), ("", self.bare)):
            fresh = [c for c in plain[space] if c not in memory]
            for start in range(0, len(fresh), 1 << 12):
                part = fresh[start : start + (1 << 12)]
                memory.update(zip(part, self.lines([space + c for c in part] if space else part), strict=True))
            self.size += sum(map(len, fresh)) * 5 + ENTRY_BYTES * len(fresh)
        # Words with a mark first: lines are made of them.
        for memory, chunk, parts in sorted(joined, key=lambda j: "\n" in j[1]):
            between = self.newline if "\n" in chunk else b""
            memory[chunk] = between.join([memory[parts[0]], *(self.bare[p] for p in parts[1:])])
            self.size += ENTRY_BYTES + 5 * len(chunk)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed little-endian unsigned 32-bit ids of every text."""
        if self.size > MEMORY_BYTES:
            self.forget()
        split = [(t or "").split(" ") for t in texts]
        heads = [chunks.pop(0) for chunks in split]
        spaced, bare = set().union(*split).difference(self.spaced), set(heads).difference(self.bare)
        if spaced or bare:
            self.learn(spaced, bare)
        out: list[bytes] = []
        for text, head, chunks in zip(texts, heads, split, strict=True):
            first = self.bare[head]
            try:
                out.append(first + b"".join(map(self.spaced.__getitem__, chunks)))
            except TypeError:  # a chunk that needs its surroundings
                out.append(self.whole([text])[0] if text else b"")
        return out


@functools.cache
def load(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)


@functools.cache
def signs(seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Place of every id, and the projection of places."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, PLACES, 1 << 20), rng.choice([-1.0, 1.0], (PLACES, DIMENSIONS))


def positions(documents: list[bytes]) -> np.ndarray:
    """Coordinates of documents (packed ids, none empty) in the cube of side 2^BITS: logarithms of their hashed counts, of
    length one, projected."""
    places, projection = signs()
    sizes = np.array([len(ids) // 4 for ids in documents])
    ids = np.frombuffer(b"".join(documents), "<u4")
    counts = np.bincount(np.repeat(np.arange(len(sizes)) * PLACES, sizes) + places[ids % len(places)])
    at = np.flatnonzero(counts)
    value = np.log1p(counts[at])
    heads = np.flatnonzero(np.diff(at // PLACES, prepend=-1))
    flat = np.add.reduceat(value[:, None] * projection[at % PLACES], heads) / np.sqrt(np.add.reduceat(value * value, heads))[:, None]
    # A logistic curve close to the normal distribution's, so that the cube is filled evenly.
    return np.minimum((1 << BITS) / (1 + np.exp(-1.7 * flat)), (1 << BITS) - 1).astype(np.int64)


def narrow(ids: bytes) -> bytes:
    values = np.frombuffer(ids, "<u4")
    return values.astype("<u2").tobytes() if values.max() < 1 << 16 else ids


def wide(ids: bytes, n: int) -> bytes:
    return ids if len(ids) == 4 * n else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of every row of ``points`` (n, dimensions), each coordinate below 2^bits.

    From the top bit down, each subcube is turned so that the curve enters it at its corner: where a coordinate has the
    bit, the lower bits of the first coordinate are flipped, else those of the two are swapped. What is left is a Gray code.
    """
    x = points.T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            has = (x[i] >> b) & 1 == 1
            swap = np.where(has, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(has, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


@dataclass(frozen=True)
class Packer:
    """Sequences of ``size`` tokens of the vocabulary file at ``path``, which lies there on every machine; ``end`` closes a
    document."""

    path: str
    size: int = 2048
    end: int = 1

    def encoded(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Stored (row, id, key, n, ids): number of ids with the end, ids as packed unsigned integers of 16 or, where one
        needs it, 32 bits."""
        path, end = self.path, np.array([self.end], "<u4").tobytes()

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Nothing here forms cycles; the collector would go through the remembered chunks again and again.
            gc.disable()
            try:
                yield from coded_batches(batches)
            finally:
                gc.enable()

        def coded_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = load(path)
            for whole in batches:
                for start in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(start, ROWS)
                    packed = [ids + end for ids in encoder.encode(batch.column("text").to_pylist())]
                    points = positions(packed)
                    n = pa.array([len(ids) // 4 for ids in packed], pa.int64())
                    packed = [narrow(ids) for ids in packed]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id"), pa.array(hilbert(points)), n, pa.array(packed, pa.binary())], ["id", "key", "n", "ids"])

        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        coded = rows.mapInArrow(encode, "id long, key long, n long, ids binary")
        return stage(coded.withColumn("row", F.monotonically_increasing_id()), "pk-ids")

    def places(self, encoded: DataFrame) -> DataFrame:
        """(row, at): number of tokens of the whole stream before each document."""
        order = ["key", "id", "row"]
        # Running sums within the tasks of the sort; the tasks' sums (a row each) are added up over all.
        ranked = encoded.select(*order, "n").repartitionByRange(*order).sortWithinPartitions(*order)

        def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done = 0
            for batch in batches:
                n = batch.column("n").to_numpy()
                before = done + np.cumsum(n) - n
                done += int(n.sum())
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("n"), pa.array(before)], ["row", "n", "before"])

        local = stage(ranked.mapInArrow(running, "row long, n long, before long").withColumn("part", F.spark_partition_id()), "pk-order")
        earlier = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
        tasks = local.groupBy(F.col("part").alias("p")).agg(F.sum("n").alias("total"))
        starts = tasks.select("p", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("start"))
        return local.join(F.broadcast(starts), F.expr("part = p")).select("row", (F.col("start") + F.col("before")).alias("at"))

    def pieces(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, start, length, doc_tokens, sequence_id, offset, ids) of every piece."""
        size = self.size
        encoded = self.encoded(docs, id_col, text_col)
        placed = encoded.select("row", "id", "n", "ids").join(
            stage(self.places(encoded), "pk-places").withColumnRenamed("row", "r"), F.expr("row = r"))

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at_row in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(at_row, ROWS)
                    at, n = batch.column("at").to_numpy(), batch.column("n").to_numpy()
                    count = (at + n - 1) // size - at // size + 1
                    owner = np.repeat(np.arange(len(n)), count)
                    sequence = at[owner] // size + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                    start = np.maximum(at[owner], sequence * size) - at[owner]
                    end = np.minimum(at[owner] + n[owner], (sequence + 1) * size) - at[owner]
                    packed = batch.column("ids").to_pylist()
                    packed = [wide(ids, int(k)) for ids, k in zip(packed, n, strict=True)]
                    ids = [packed[o][4 * a : 4 * b] for o, a, b in zip(owner.tolist(), start.tolist(), end.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        batch.column("id").take(pa.array(owner)), pa.array(start), pa.array(end - start), pa.array(n[owner]), pa.array(sequence),
                        pa.array(at[owner] + start - sequence * size), pa.array(ids, pa.binary()),
                    ], ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        return placed.select("id", "n", "ids", "at").mapInArrow(
            cut, "id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")

    def sequences(self, pieces: DataFrame) -> DataFrame:
        """(sequence_id, length, ids): the tokens of every sequence; a sequence has at most ``size`` pieces."""
        parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
        joined = F.aggregate(parts, F.lit(bytearray()), lambda acc, p: F.concat(acc, p["ids"]))
        return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
