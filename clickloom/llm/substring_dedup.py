"""Substring dedup of words by relative Lempel-Ziv parsing.

Removed is every word that a window of ``width`` words covers whose words also start earlier. ``repeats`` cuts the
corpus into blocks: the stretches of words around equal anchors, the only places where windows can agree. Each
stretch is parsed against all earlier stretches of its collection, which form the reference: a factor starts where
the index of the reference knows the next ``width`` words and is drawn out as far as the reference goes on alike, so
every factor is long enough to be a duplicate span. Windows that run over a factor's end are looked up one by one;
what no factor covers becomes new reference.

Defined results: words are what lies between white space of ``[\\x20\\x09-\\x0D]``, unchanged; a null text has none,
and texts of fewer than ``width`` words lose none. Rows that share an id don't remove each other's words; a null id
is the least. An empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickloom.llm.hashing import word_hashes, word_spans
from clickloom.llm.repeats import NO_ID, Repeats, in_parts
from clickloom.llm.suffix_dedup import prepared

WORD_BYTES = 8


def parse(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, start, class) of every window of ``width`` words; a word is WORD_BYTES long.

    The class of a window is the number of its first occurrence in the reference.
    """
    step, span = WORD_BYTES, WORD_BYTES * width
    index: dict[bytes, int] = {}
    # Where a class stands in the reference: the string and the byte behind its last word.
    source: list[tuple[bytes, int]] = []
    kinds: list[int] = []
    counts = []
    for string in strings:
        at, n = 0, len(string)
        begin = len(kinds)
        while at + span <= n:
            known = index.setdefault(string[at : at + span], len(source))
            kinds.append(known)
            at += step
            if known == len(source):
                source.append((string, at - step + span))
                continue
            # A factor: the windows behind go on alike as long as the reference's next word is the next word here.
            reference, behind = source[known]
            while at + span <= n and string[at + span - step : at + span] == reference[behind : behind + step]:
                # The reference's own next window; it has a class, but only its first occurrence carries the number.
                kinds.append(index[string[at : at + span]])
                behind += step
                at += step
        counts.append(len(kinds) - begin)
    counts_ = np.array(counts, np.int64)
    which = np.repeat(np.arange(len(strings)), counts_)
    start = np.arange(len(kinds)) - np.repeat(np.cumsum(counts_) - counts_, counts_)
    return which, start, np.array(kinds, np.int64)


def word_repeats(width: int = 20, seed: int = 6) -> Repeats:
    def symbols(texts: list[str | None]) -> list[np.ndarray]:
        encoded = [(t or "").encode("utf-8") for t in texts]
        hashes, starts, _ = word_hashes(np.frombuffer(b" ".join(encoded), np.uint8))
        ends = np.cumsum([len(e) + 1 for e in encoded])
        return np.split(hashes, np.searchsorted(starts, ends[:-1]))

    def content(text: str, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        words = symbols([text])[0]
        return [words[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]

    return Repeats(width, seed, symbols, content, lambda strings: parse(strings, width), WORD_BYTES)


SCHEMA = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def kept_words(docs: DataFrame, width: int = 20, hashed: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept): the words left, joined by one space, or their SHA-256 in hexadecimal digits."""
    op = word_repeats(width)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, stretches in zip(*(in_parts(batch.column(c)) for c in ("id", "text", "stretches")), strict=True):
                rows = []
                encoded = [(t or "").encode("utf-8") for t in texts]
                spans = [word_spans(np.frombuffer(d, np.uint8)) for d in encoded]
                covered = op.covered(texts, [len(a) for a, _ in spans], stretches)
                for i, data, (starts, ends), gone in zip(ids, encoded, spans, covered, strict=True):
                    left = b" ".join([data[a:b] for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist(), strict=True)])
                    out = hashlib.sha256(left).hexdigest() if hashed else left.decode("utf-8")
                    rows.append((None if i == NO_ID else i, len(starts), int(gone.sum()), out))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], schema=SCHEMA)

    schema = "id long, n_words long, n_removed long, kept string"
    return op.with_stretches(prepared(docs, id_col, text_col)).select("id", "text", "stretches").mapInArrow(keep, schema)
