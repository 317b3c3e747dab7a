"""Spelling variants: words of a corpus, their neighbours at one edit, and the form that each is a variant of.

Neighbours come from a dictionary of trie-node pairs. Every prefix of a word is a node of the forward trie, every suffix one
of the reversed trie, and both are numbered; a pair (prefix node, suffix node) names a string exactly. A word stands under
the pairs around each of its letters (skipped) and under the pairs that meet between two letters (gap):

* two words under one pair by skipping differ in that one letter;
* a word that skips and a word with a gap under one pair differ by the skipped letter. Of a run of equal letters only the
  last is taken, so such words meet once.

A pair holds words that differ in one letter, so never more than the alphabet has letters (126, with both cases of the
Latin-1 letters); no group grows with the corpus.

Tries are numbered along range-sorted words, a task at a time: nodes that a word shares with the one before keep their
number. A node that runs over the border of two ranges has a number on either side; the border words (two a range) reach
the driver, which maps the later number to the earlier one.

Defined results: a null text has no words, nor has an empty one; a null id counts as empty text in the deletion rule.
Repeated rows count each on their own. An empty table gives no words. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.sources.stage import stage

# Fixed pattern of the letters of a word.
LETTERS = "A-Za-zÀ-ÿ"
LOWER = {c: c + 32 for c in range(65, 91)}
# Distinct words that a task holds before it hands their counts on.
HELD = 200_000
GAP, LAST_OF_RUN, WITHIN_RUN = 0, 1, 2


def lowered(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(LOWER)


def counted_words(docs: DataFrame, least: int, noise: int | None, id_col: str, text_col: str) -> DataFrame:
    """(word, n) over all texts: runs of at least ``least`` letters, A-Z lowered. With ``noise``, the runs of a document whose
    hash it divides lose one letter first (see ``words``)."""
    runs = re.compile(f"[{LETTERS}]{{{least},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for name, text in zip(batch.column("id"), batch.column("text"), strict=True):
                found: Counter[str] = Counter()
                for run, n in Counter(runs.findall(text.as_py() or "")).items():
                    found[lowered(run)] += n
                start = zlib.crc32(f"{name.as_py() or ''}:".encode())
                for run, n in found.items():
                    h = zlib.crc32(run.encode(), start) if noise else 1
                    if noise and h % noise == 0:
                        cut = h % len(run)
                        run = run[:cut] + run[cut + 1 :]
                        if len(run) < least:
                            continue
                    held[run] += n
                if len(held) > HELD:
                    yield out()
        yield out()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def ranked(words: DataFrame) -> DataFrame:
    """(word, n, wid): ``wid`` counts from 1 in the order of n, largest first, then of the words."""
    from clickloom.operators.indexing import global_index

    return global_index(words.select("word", "n"), [F.desc("n"), "word"], "wid").withColumn("wid", F.col("wid") + 1)


def numbered(words: DataFrame, backwards: bool) -> tuple[DataFrame, dict[int, int]]:
    """((wid, nodes), numbers to replace): nodes of all prefixes (suffixes) of each word, the empty one, 0, first."""
    key = F.reverse("word") if backwards else F.col("word")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fresh = (part << 40) + 1
        last, path = "", [0]
        first = True
        held = None
        for batch in batches:
            keys, nodes = batch.column("key").to_pylist(), []
            for word in keys:
                same = 0
                for a, b in zip(last, word, strict=False):
                    if a != b:
                        break
                    same += 1
                new = len(word) - same
                path = [*path[: same + 1], *range(fresh, fresh + new)]
                fresh += new
                last = word
                nodes.append(path)
            if not keys:
                continue
            if held is not None:
                yield held[0].append_column("edge", pa.array(held[1], pa.int64()))
            edge = np.full(len(keys), -1)
            if first:
                edge[0], first = 2 * part, False
            held = pa.RecordBatch.from_arrays([batch.column("key"), batch.column("wid"), pa.array(nodes, pa.list_(pa.int64()))], ["key", "wid", "nodes"]), edge
        if held is not None:
            yield held[0].append_column("edge", pa.array(held[1], pa.int64()))
            # The last row of a range once more, as its border.
            row = held[0].slice(held[0].num_rows - 1)
            yield pa.RecordBatch.from_arrays([row.column("key"), pa.nulls(1, pa.int64()), row.column("nodes"), pa.array([2 * part + 1])], ["key", "wid", "nodes", "edge"])

    keyed = words.select(key.alias("key"), "wid").repartitionByRange("key").sortWithinPartitions("key")
    table = stage(keyed.mapInArrow(number, "key string, wid long, nodes array<long>, edge long"), "sp-trie")
    replace: dict[int, int] = {}
    before = None
    # Two rows for each range.
    for row in sorted(table.where("edge >= 0").collect(), key=lambda r: r["edge"]):
        nodes = [replace.get(x, x) for x in row["nodes"]]
        if row["edge"] % 2 == 0 and before is not None:
            for a, b, old, new in zip(before[0], row["key"], before[1][1:], nodes[1:], strict=False):
                if a != b:
                    break
                replace[new] = old
        if row["edge"] % 2 == 1:
            before = row["key"], nodes
    return table.where("wid IS NOT NULL").select("wid", "nodes"), replace


def pairs(words: DataFrame) -> DataFrame:
    """(prefix, suffix, kind, wid): the node pairs of every word."""
    forward, one = numbered(words, False)
    backward, two = numbered(words, True)
    maps = [(np.array(sorted(m), np.int64), np.array([m[k] for k in sorted(m)], np.int64)) for m in (one, two)]

    def replaced(nodes: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        keys, values = known
        if not len(keys):
            return nodes
        at = np.minimum(np.searchsorted(keys, nodes), len(keys) - 1)
        return np.where(keys[at] == nodes, values[at], nodes)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                prefixes = replaced(batch.column("nodes").flatten().to_numpy(), maps[0])
                suffixes = replaced(batch.column("ends").flatten().to_numpy(), maps[1])
                texts = batch.column("word").to_pylist()
                wid = batch.column("wid").to_numpy()
                size = np.array([len(t) for t in texts])
                letters = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
                begin = np.cumsum(size + 1) - size - 1  # of a word's nodes; it has one more than letters
                owner = np.repeat(np.arange(len(texts)), size)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
                skip_p = prefixes[begin[owner] + place]
                skip_s = suffixes[begin[owner] + size[owner] - place - 1]
                run = np.append(letters[1:] == letters[:-1], False) & (place < size[owner] - 1)
                gap = np.repeat(np.arange(len(texts)), size + 1)
                at = np.arange(len(gap)) - begin[gap]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([skip_p, prefixes[begin[gap] + at]])), pa.array(np.concatenate([skip_s, suffixes[begin[gap] + size[gap] - at]])),
                    pa.array(np.concatenate([np.where(run, WITHIN_RUN, LAST_OF_RUN), np.full(len(gap), GAP)]).astype(np.int32)),
                    pa.array(np.concatenate([wid[owner], wid[gap]])),
                ], ["prefix", "suffix", "kind", "wid"])

    rows = words.select("word", "wid").join(forward.withColumnRenamed("wid", "f"), F.expr("wid = f")).join(
        backward.select(F.col("wid").alias("b"), F.col("nodes").alias("ends")), F.expr("wid = b"))
    return rows.select("word", "wid", "nodes", "ends").mapInArrow(dealt, "prefix long, suffix long, kind int, wid long")


def neighbours(dictionary: DataFrame) -> DataFrame:
    """(wid, n_near, best): number of words at one edit and the least wid among them, for words that have any."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("prefix", "suffix", "kind", "wid")])
            rows = rows if rest is None else np.concatenate([rest, rows], axis=1)
            same = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(0))
            cut = same[-1] + 1 if len(same) else 0  # the last pair may go on in the next batch
            rest = rows[:, cut:]
            if cut:
                yield settled(rows[:, :cut])
        if rest is not None and rest.shape[1]:
            yield settled(rest)

    partial = dictionary.repartition("prefix", "suffix").sortWithinPartitions("prefix", "suffix", "wid").mapInArrow(met, "wid long, n long, best long")
    return partial.groupBy("wid").agg(F.sum("n").alias("n_near"), F.min("best").alias("best"))


NONE = np.iinfo(np.int64).max


def settled(rows: np.ndarray) -> pa.RecordBatch:
    """What the words under each pair say to each other; ``rows`` are whole pairs, by ascending wid within."""
    head = np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(0)])
    group = np.cumsum(head) - 1
    n = group[-1] + 1
    kind, wid = rows[2], rows[3]

    def least(of: np.ndarray, but: np.ndarray | None = None) -> np.ndarray:
        out = np.full(n, NONE)
        use = of if but is None else of & (wid != but[group])
        np.minimum.at(out, group[use], wid[use])
        return out

    skips, last, gap = kind != GAP, kind == LAST_OF_RUN, kind == GAP
    first, gapped, first_last = least(skips), least(gap), least(last)
    second = least(skips, first)
    n_skips, n_last, n_gap = (np.bincount(group[x], minlength=n) for x in (skips, last, gap))
    count = np.where(skips, n_skips[group] - 1 + np.where(last, n_gap[group], 0), n_last[group])
    other = np.where(first[group] == wid, second[group], first[group])
    best = np.where(skips, np.minimum(other, np.where(last, gapped[group], NONE)), first_last[group])
    some = count > 0
    return pa.RecordBatch.from_arrays([pa.array(wid[some]), pa.array(count[some]), pa.array(best[some])], ["wid", "n", "best"])


def variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n), each word once.

    The form is the near word of largest n, the first of equals in code-point order, if it has ``factor`` times the word's
    n. Words without any near word take no part in the forms. From form to form n grows by the factor, so a chain is short;
    roots are found by doubling.
    """
    known = stage(ranked(words), "sp-words")
    near = stage(neighbours(pairs(known)), "sp-near")
    names = known.select(F.col("wid").alias("b"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    found = known.join(near.select(F.col("wid").alias("w"), "n_near", "best"), F.expr("wid = w"), "left").join(names, F.expr("best = b"), "left")
    high = F.col("form_n") >= factor * F.col("n")
    found = stage(found.select(
        "wid", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(high, F.col("best")).alias("up"),
        F.when(high, F.col("form")).alias("form"), F.when(high, F.col("form_n")).alias("form_n")), "sp-forms")
    chains = found.where("up IS NOT NULL").select("wid", "up")
    while True:
        chains = stage(chains, "sp-chains")
        ahead = chains.select(F.col("wid").alias("a"), F.col("up").alias("further"))
        longer = chains.join(ahead, F.expr("up = a"), "left")
        if longer.where("further IS NOT NULL").isEmpty():
            break
        chains = longer.select("wid", F.coalesce("further", "up").alias("up"))
    roots = chains.select(F.col("wid").alias("c"), "up").join(known.select(F.col("wid").alias("r"), F.col("word").alias("root")), F.expr("up = r")).select("c", "root")
    return found.join(roots, F.expr("wid = c"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_groups(
    docs: DataFrame, least: int = 7, occurrences: int = 2, factor: int = 10, noise: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``variants`` of the words of at least ``least`` letters that occur ``occurrences`` times or more."""
    return variants(counted_words(docs, least, noise, id_col, text_col).where(F.col("n") >= occurrences), factor)
