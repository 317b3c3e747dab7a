"""BPE encoding and decoding with a public vocabulary.

Words of the pre-tokenizer are merged with a segment tree over the ranks of adjacent pairs: the root names the
leftmost pair of lowest rank, a merge updates three leaves in logarithmic time, and the word is done when the root
holds no mergeable pair. A word of n symbols so takes O(n log n), however long it is.

Defined results: a null text counts as empty and has no ids; the decoded text of no ids is empty. Rows are treated
one by one, so repeated rows repeat their results and an empty table gives an empty table. Only the text column is
read; all other columns pass through.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEVER = 1 << 62
# Fixed values of the vocabulary file's normalizer: the white space that is folded to one space.
SPACES = regex.compile("[\t-\r \x85\xa0  -     　]+")
SEPARATORS = regex.compile("[\x1c-\x1f]")
# Words, and as many chunks between spaces, that one Python worker remembers, and bytes of each; a full memory is emptied.
MEMORY_WORDS = 250_000
MEMORY_BYTES = 64 << 20
# Chunks of texts held at once while their unknown words are encoded together.
HELD_WORDS = 100_000
# Longer words (in bytes) get a tree of their own instead of a row in a table of trees.
ROW_SYMBOLS = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if it is visible, else the next one from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def merge_pairs(symbols: list[int], pairs: dict[int, tuple[int, int]]) -> list[int]:
    """Merge adjacent ids, always the leftmost pair of lowest rank, with a segment tree.

    ``pairs`` maps ``left << 32 | right`` to (rank, merged id). A leaf holds ``rank << 32 | place`` of the pair that
    starts at this place, or NEVER; an inner node holds the smaller of its children.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    get = pairs.get
    size = 1 << (n - 1).bit_length()
    tree = [NEVER] * (2 * size)
    for i in range(n - 1):
        found = get(symbols[i] << 32 | symbols[i + 1])
        if found:
            tree[size + i] = found[0] << 32 | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while tree[1] != NEVER:
        i = tree[1] & 0xFFFFFFFF
        j = after[i]
        symbols[i] = pairs[symbols[i] << 32 | symbols[j]][1]
        symbols[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
        h = before[i]
        for place, right in ((h, i), (i, k), (j, n)):
            if place < 0:
                continue
            found = get(symbols[place] << 32 | symbols[right]) if right < n else None
            key = found[0] << 32 | place if found else NEVER
            at = size + place
            if tree[at] == key:
                continue
            tree[at] = key
            while at > 1:
                other = tree[at ^ 1]
                at >>= 1
                low = key if key < other else other
                if tree[at] == low:
                    break
                tree[at] = key = low
    return [s for s in symbols if s >= 0]


class MergeTable:
    """Sorted pair keys for looking up whole arrays of pairs at once."""

    def __init__(self, pairs: dict[int, tuple[int, int]]) -> None:
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        ranks = np.fromiter((rank for rank, _ in pairs.values()), np.int64, len(pairs))
        self.merged = np.zeros(len(pairs), np.int64)
        self.merged[ranks] = np.fromiter((token for _, token in pairs.values()), np.int64, len(pairs))
        self.keys, self.ranks = keys[order], ranks[order]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, -1 where there is none or a side is missing (negative)."""
        key = (left << 32) | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], -1)


def merge_rows(symbols: np.ndarray, table: MergeTable) -> np.ndarray:
    """``merge_pairs`` for many words at once: one segment tree per row, all trees advance by one merge a step.

    ``symbols`` is (words, size), size a power of two, padded with -1; merged-away places come back as -1.
    """
    n, size = symbols.shape
    symbols = np.hstack([symbols, np.full((n, 1), -1)])  # place ``size``: what follows the last symbol
    after = np.tile(np.arange(1, size + 2), (n, 1))
    before = np.tile(np.arange(-1, size), (n, 1))
    tree = np.full((n, 2 * size), NEVER, np.int64)

    def leaf(rank: np.ndarray, place: np.ndarray) -> np.ndarray:
        return np.where(rank >= 0, rank * size + place, NEVER)

    tree[:, size:] = leaf(table.rank(symbols[:, :-1], symbols[:, 1:]), np.arange(size))
    level = size
    while level > 1:
        level >>= 1
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
    rows = np.flatnonzero(tree[:, 1] != NEVER)
    while len(rows):
        rank, i = np.divmod(tree[rows, 1], size)
        j = after[rows, i]
        k = np.minimum(after[rows, j], size)
        h = before[rows, i]
        symbols[rows, i] = table.merged[rank]
        symbols[rows, j] = -1
        after[rows, i] = k
        before[rows, np.minimum(k, size - 1)] = np.where(k < size, i, before[rows, size - 1])
        tree[rows, size + j] = NEVER
        tree[rows, size + i] = leaf(table.rank(symbols[rows, i], symbols[rows, k]), i)
        left = np.flatnonzero(h >= 0)
        at = rows[left]
        tree[at, size + h[left]] = leaf(table.rank(symbols[at, h[left]], symbols[at, i[left]]), h[left])
        for who, place in ((rows, i), (rows, j), (at, h[left])):
            place = place + size
            while place[0] > 1 if len(place) else False:
                place >>= 1
                tree[who, place] = np.minimum(tree[who, 2 * place], tree[who, 2 * place + 1])
        rows = rows[tree[rows, 1] != NEVER]
    return symbols[:, :-1]


class WordBpe:
    """Encoder and decoder of a vocabulary file of word BPE with an end-of-word suffix."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.tokens = [""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + self.suffix] for x in letters]
        self.pairs = {
            vocab[a] << 32 | vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in enumerate(model["merges"])
        }
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", SPACES.pattern[1:-2])
        self.words = regex.compile(pattern)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.table = MergeTable(self.pairs)
        self.memory = {word: np.array([i], "<u4").tobytes() for word, i in self.special.items()}
        self.chunks: dict[str, bytes] = {}
        self.word_bytes = self.chunk_bytes = 0

    def encode_word(self, word: str) -> bytes:
        data = word.encode("utf-8")
        symbols = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        return np.array(merge_pairs(symbols, self.pairs), "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Encode words that aren't remembered yet, those of like length together."""
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            data = word.encode("utf-8")
            by_size.setdefault(1 << max(1, (len(data) - 1).bit_length()), []).append((word, data))
        inner, last = np.array(self.inner), np.array(self.last)
        for size, group in by_size.items():
            if size > ROW_SYMBOLS:
                self.memory.update((word, self.encode_word(word)) for word, _ in group)
                continue
            step = max(1, (1 << 20) // size)
            for start in range(0, len(group), step):
                part = group[start : start + step]
                lengths = np.array([len(d) for _, d in part])
                flat = np.frombuffer(b"".join(d.ljust(size, b"\0") for _, d in part), np.uint8).reshape(-1, size)
                places = np.arange(size)
                symbols = np.where(places == lengths[:, None] - 1, last[flat], inner[flat])
                symbols[places >= lengths[:, None]] = -1
                done = merge_rows(symbols, self.table)
                kept = done >= 0
                packed, ends = done[kept].astype("<u4").tobytes(), np.cumsum(kept.sum(1)).tolist()
                self.memory.update(
                    (word, packed[4 * a : 4 * b]) for (word, _), a, b in zip(part, [0, *ends], ends, strict=False)
                )

    def normal(self, text: str) -> str:
        """Composed form, each letter lower-cased by itself; white space is left to the pre-tokenizer, which drops it."""
        text = unicodedata.normalize("NFC", text)
        # str.lower() looks at the neighbours of a capital sigma, the vocabulary's rule doesn't.
        return "σ".join(x.lower() for x in text.split("Σ")) if "Σ" in text else text.lower()

    def pieces(self, chunk: str) -> list[str]:
        """Words of the pre-tokenizer; special tokens stand as they are."""
        if "<|" not in chunk:
            return self.words.findall(self.normal(chunk))
        out: list[str] = []
        for part in self.cut.split(chunk):
            out.extend([part] if part in self.special else self.words.findall(self.normal(part)))
        return out

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text as packed little-endian unsigned 32-bit integers; a few texts are held at a time.

        No token spans white space, so texts are cut there first, and each distinct chunk is looked at once.
        """
        held: list[list[str]] = []
        size = 0
        for text in texts:
            text = text or ""
            # The four separators are white space to str.split() but not to the vocabulary.
            held.append(SPACES.split(text) if SEPARATORS.search(text) else text.split())
            size += len(held[-1])
            if size >= HELD_WORDS:
                yield from self.packed(held)
                held, size = [], 0
        yield from self.packed(held)

    def packed(self, held: list[list[str]]) -> Iterator[bytes]:
        chunks = {chunk for part in held for chunk in part}
        if len(self.chunks) + len(chunks) > MEMORY_WORDS or self.chunk_bytes > MEMORY_BYTES:
            self.chunks.clear()
            self.chunk_bytes = 0
        fresh = {chunk: self.pieces(chunk) for chunk in chunks if chunk not in self.chunks}
        words = {word for pieces in fresh.values() for word in pieces}
        if len(self.memory) + len(words) > MEMORY_WORDS or self.word_bytes > MEMORY_BYTES:
            self.memory.clear()
            self.word_bytes = 0
            self.memory.update((word, np.array([i], "<u4").tobytes()) for word, i in self.special.items())
        new = {word for word in words if word not in self.memory}
        self.learn(new)
        # A letter and its share of the ids take some five bytes.
        self.word_bytes += 5 * sum(map(len, new))
        self.chunk_bytes += 5 * sum(map(len, fresh))
        get = self.memory.__getitem__
        self.chunks.update((chunk, b"".join(map(get, pieces))) for chunk, pieces in fresh.items())
        for part in held:
            yield b"".join(map(self.chunks.__getitem__, part))

    def decode(self, ids: bytes) -> str:
        """The tokens joined by spaces: this vocabulary names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.cache
def load(path: str) -> WordBpe:
    """One per Python worker: the memory of words outlives a task."""
    return WordBpe(path)


@dataclass(frozen=True)
class Bpe:
    """Column expressions for a vocabulary file that lies at ``path`` on every machine."""

    path: str

    def ids(self, text: str = "text") -> Column:
        """``array<int>`` of token ids."""
        path = self.path

        @F.pandas_udf("array<int>")
        def encode(texts: pd.Series) -> pd.Series:
            bpe = load(path)
            return pd.Series([np.frombuffer(ids, "<i4") for ids in bpe.encode_all(texts)], dtype=object)

        return encode(F.col(text))

    def text(self, ids: str) -> Column:
        """Decoded text of an ``array<int>`` of token ids (null: empty)."""
        path = self.path

        @F.pandas_udf("string")
        def decode(values: pd.Series) -> pd.Series:
            bpe = load(path)
            return pd.Series([bpe.decode(np.asarray([] if v is None else v, "<u4").tobytes()) for v in values], dtype=object)

        return decode(F.col(ids))

    def encoded(self, docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
        """Columns ``keep``, n_tokens, ids and the SHA-256 of the text decoded from the ids, of every row.

        Rows go through a worker a few at a time, and their ids leave as one buffer, so a worker's memory is bounded by
        a few texts and the remembered words.
        """
        path = self.path

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bpe = load(path)
            for batch in batches:
                for start in range(0, batch.num_rows, 128):
                    part = batch.slice(start, 128)
                    packed = list(bpe.encode_all(part.column(text).to_pylist()))
                    counts = np.array([len(ids) // 4 for ids in packed], np.int64)
                    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                    ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(packed), "<i4")))
                    decoded = pa.array([hashlib.sha256(bpe.decode(one).encode("utf-8")).hexdigest() for one in packed], pa.string())
                    columns = [*[part.column(c) for c in keep], pa.array(counts), ids, decoded]
                    yield pa.RecordBatch.from_arrays(columns, [*keep, "n_tokens", "ids", "decoded_sha256"])

        types = ", ".join(f"`{c}` {kind}" for c, kind in docs.select(*keep).dtypes)
        return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(encode, f"{types}, n_tokens long, ids array<int>, decoded_sha256 string")

    def digests(self, text: str = "text") -> Column:
        """Struct of the number of ids and the hashes of ids and decoded text; ids and text stay in the worker."""
        path = self.path

        @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
        def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            bpe = load(path)
            for texts in batches:
                rows = []
                for ids in bpe.encode_all(texts):
                    decoded = hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest()
                    rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded))
                yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

        return both(F.col(text))
