"""Suffix-array dedup of byte strings, by column-wise construction over collections of documents.

Removed is every byte that a string of ``width`` bytes covers which starts earlier too. ``repeats`` brings together the
stretches of text that can agree, as collections of short strings. The suffix array of a collection is built column
by column: each round inserts, for every string at once, the suffix one symbol longer; its place follows from the
Burrows-Wheeler transform of what is there (how many symbols are smaller, how many equal ones stand before), and the
common prefixes of the new suffixes and their followers follow from minima over the old ones. The collections
reach a task one after the other from Spark's sorted, spilled shuffle files, which take the place of the method's
sequential files, so memory is bounded by one collection.

Defined results: a null text counts as empty; texts shorter than ``width`` bytes lose nothing. Rows that share an id
don't remove each other's bytes; a null id is the least. Bytes left over are joined; the operator on texts drops a
character that lost a byte. An empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.hashing import BYTES
from clickloom.llm.repeats import NO_ID, Repeats, in_parts


def suffix_order(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of a collection in order: (string, length, common prefix with the one before).

    Ends of strings are smaller than any byte and differ by string; empty suffixes are part of the order.
    """
    m = len(strings)
    data = np.frombuffer(b"".join(strings), np.uint8)
    length = np.array([len(s) for s in strings], np.int64)
    end = np.cumsum(length)
    longest = int(length.max(initial=0))
    # Bytes that occur, in order, from 1 on; 0 stands before a string's first byte. Few symbols sort in one pass.
    present = np.bincount(data, minlength=256) > 0
    code = np.cumsum(present).astype(np.uint8 if present.sum() < 255 else np.int16)
    data = code[data]
    small = np.uint8 if longest < 255 else np.int32
    bits = 8 if longest < 255 else 32
    pack = np.int32 if longest < 255 and m < 1 << 22 else np.int64
    before = np.where(length > 0, data[np.maximum(end, 1) - 1] if len(data) else 0, 0).astype(code.dtype)
    # A suffix is its string and its length in one number.
    name = (np.arange(m) << bits).astype(pack)
    common = np.zeros(m, small)
    at = np.arange(m)  # place of each string's longest suffix so far
    for round_ in range(1, longest + 1):
        live = np.flatnonzero(length >= round_)
        order = np.argsort(before, kind="stable")
        ended = int(np.count_nonzero(before == 0))
        grows = np.zeros(len(before), bool)
        grows[at[live]] = True
        rank = np.flatnonzero(grows[order])
        string = name[order[rank]] >> bits
        # Ranks whose common prefix changes: the inserted suffixes and those that follow them.
        changed = np.zeros(len(order) + 1, bool)
        changed[rank] = True
        changed[rank + 1] = True
        changed = np.flatnonzero(changed[:-1])
        touched = changed[changed > ended]
        left, right = order[touched - 1], order[touched]
        alike = before[left] == before[right]
        touched, left, right = touched[alike], left[alike], right[alike]
        bounds = np.empty(2 * len(left), np.int64)
        bounds[::2], bounds[1::2] = left + 1, right + 1
        least = np.minimum.reduceat(np.append(common, small(0)), bounds)[::2] if len(bounds) else np.empty(0, small)

        place = m + rank - ended
        symbol = np.where(length[string] > round_, data[np.maximum(end[string] - round_ - 1, 0)], 0)
        old = np.ones(len(before) + len(live), bool)
        old[place] = False

        def merge(was: np.ndarray, new: np.ndarray, old: np.ndarray = old, place: np.ndarray = place) -> np.ndarray:
            out = np.empty(len(old), was.dtype)
            out[old] = was
            out[place] = new
            return out

        before, name = merge(before, symbol), merge(name, (string.astype(np.int64) << bits) + round_)
        common = merge(common, 0)
        # Followers of an inserted suffix that begin with another byte share nothing with it.
        common[m + changed[changed >= ended] - ended] = 0
        common[m + touched - ended] = least + 1
        at[string] = place
    name = name.astype(np.int64)
    return name >> bits, name & ((1 << bits) - 1), common


def equal_windows(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, start, class) of every window of ``width`` bytes."""
    owner, size, common = suffix_order(strings)
    kind = np.cumsum(common < width)
    long = size >= width
    length = np.array([len(s) for s in strings], np.int64)
    owner = owner[long]
    return owner, length[owner] - size[long], kind[long]


def byte_repeats(width: int = 100, seed: int = 32) -> Repeats:
    def symbols(texts: list[str | None]) -> list[np.ndarray]:
        return [BYTES[np.frombuffer((t or "").encode("utf-8"), np.uint8)] for t in texts]

    def content(text: str, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        data = text.encode("utf-8")
        return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]

    return Repeats(width, seed, symbols, content, lambda strings: equal_windows(strings, width), 1)


def prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))


def digests(docs: DataFrame, width: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    op = byte_repeats(width)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, stretches in zip(*(in_parts(batch.column(c)) for c in ("id", "text", "stretches")), strict=True):
                rows = []
                encoded = [np.frombuffer((t or "").encode("utf-8"), np.uint8) for t in texts]
                for i, data, gone in zip(ids, encoded, op.covered(texts, [len(d) for d in encoded], stretches), strict=True):
                    spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                    kept = hashlib.sha256(data[~gone].tobytes()).hexdigest()
                    rows.append((None if i == NO_ID else i, len(data), int(gone.sum()), spans, kept))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], schema=SCHEMA)

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return op.with_stretches(prepared(docs, id_col, text_col)).select("id", "text", "stretches").mapInArrow(digest, schema)


SCHEMA = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def without_repeats(docs: DataFrame, width: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated strings cut out of the text; null texts stay null. Columns and rows stay."""
    op = byte_repeats(width)
    found = op.removed(prepared(docs, id_col, text_col))
    by_row = found.groupBy(F.col("id").alias("_cut_id"), F.col("mark").alias("_cut_mark")).agg(
        F.collect_list(F.struct("first", "last")).alias("_cut")
    )

    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                some, stretches = part.column(text_col).to_pylist(), part.column("_cut").to_pylist()
                encoded = [np.frombuffer((t or "").encode("utf-8"), np.uint8) for t in some]
                gone = op.covered(some, [len(d) for d in encoded], stretches)
                out = [None if t is None else d[~g].tobytes().decode("utf-8", "ignore") for t, d, g in zip(some, encoded, gone, strict=True)]
                kept = [pa.array(out, pa.string()) if c == text_col else part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays(kept, names)

    from clickloom.sources.stage import stage

    mark = (F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")) - F.lit(1 << 31)).cast("int")
    here = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) == F.col("_cut_id")
    joined = docs.join(stage(by_row, "cut-stretches"), here & (mark == F.col("_cut_mark")), "left")
    return joined.select(*names, "_cut").mapInArrow(cut, docs.schema)
