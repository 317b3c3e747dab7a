"""MinHash near-dedup with b-bit signatures.

A document is the set of its word shingles. Documents of equal sets are one class. Bands of minima name candidate
buckets; each class keeps only the four low bits of its minima, packed in planes, and inside a bucket the similarity
is estimated from bit counts, corrected for chance collisions. Estimates near the threshold or above only gather
classes into families: each bucket (cut into chunks, a cell per pair of chunks) returns one edge per class, never a
row per pair. Families are then compared on their full sets, again in cells, by exact counts, and the confirmed links
give the components.

With 25 bands of 5 a pair at similarity 0.8 meets with probability 0.99995; the estimate's floor lies over four
standard deviations below the threshold.

Defined results: words are what lies between white space of ``[\\x20\\x09-\\x0D]``, A-Z lowered. A text of fewer words
than a shingle is one shingle; a null text or one without words has an empty set and is linked with nothing, and so is
a row without an id, whose component is null. Rows that share an id and a set count once in ``near_duplicates``; the id
is the document's name, so rows that share it belong together. An empty table stays empty; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.components import connected_components
from clickloom.llm.embedding_dedup import groups, least_reachable
from clickloom.llm.hashing import LOWER, Spans, U, mix, word_hashes
from clickloom.sources.stage import stage

BANDS, ROWS, BITS = 25, 5, 4
MINIMA = 128
CHUNK = 256
# Shingles of a chunk of a family, if it has more than one document.
CHUNK_SHINGLES = 1 << 16


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    data = LOWER[np.frombuffer((text or "").encode("utf-8"), np.uint8)]
    words = word_hashes(data)[0]
    if not len(words):
        return words
    return np.unique(Spans(words).rolling(min(width, len(words))))


def minima(hashes: np.ndarray, count: int = MINIMA, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * U(2) + U(1)
    b = rng.integers(0, 1 << 63, count, dtype=np.uint64)
    out = np.full(count, ~U(0))
    step = max(1, (1 << 18) // count)
    for start in range(0, len(hashes), step):
        part = hashes[start : start + step]
        np.minimum(out, (part[:, None] * a + b).min(0), out=out)
    return out


def pack(low: np.ndarray) -> bytes:
    """Planes of the low bits: bit i of every minimum side by side."""
    planes = (low[None, :] >> np.arange(BITS, dtype=np.uint64)[:, None]) & U(1)
    return np.packbits(planes.astype(np.uint8), axis=1).tobytes()


def estimate(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of all rows of ``left`` with all of ``right`` from packed planes, corrected for chance collisions."""
    differ = np.zeros((len(left), len(right), MINIMA // 64), np.uint64)
    for plane in range(BITS):
        words = slice(plane * MINIMA // 64, (plane + 1) * MINIMA // 64)
        differ |= left[:, None, words] ^ right[None, :, words]
    same = 1 - np.bitwise_count(differ).sum(-1, dtype=np.int64) / MINIMA
    chance = 0.5**BITS
    return (same - chance) / (1 - chance)


def screen(packed: np.ndarray, side: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a cell whose estimate reaches the floor."""
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if side.any() else left
    found = []
    for start in range(0, len(left), 64):
        part = left[start : start + 64]
        i, j = np.nonzero(estimate(packed[part], packed[right]) >= floor)
        found.append((part[i], right[j]))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = i != j
    return i[keep], j[keep]


def confirm(sets: list[np.ndarray], side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a cell with ``100 * common >= percent * union``, by exact counts.

    Places in the sorted union of all shingles become columns of a 0/1 matrix; what only one set holds is left out.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = held[column] > 1
    owner, column = owner[shared], column[shared]
    del values
    common = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = max(1, (1 << 22) // len(sets))
    distinct = np.cumsum(np.concatenate([[0], np.diff(column) != 0])) if len(column) else column
    for start in range(0, int(distinct[-1]) + 1 if len(distinct) else 0, width):
        a, b = np.searchsorted(distinct, [start, start + width])
        block = np.zeros((len(sets), width), np.float32)
        block[owner[a:b], distinct[a:b] - start] = 1
        common += block @ block.T
    counts = common.astype(np.int64)
    linked = 100 * counts >= percent * (sizes[:, None] + sizes[None, :] - counts)
    linked &= np.triu(np.ones(linked.shape, bool), 1)
    if side.any():
        linked &= side[:, None] != side[None, :]
    return np.nonzero(linked)


def cut_in_cells(rows: DataFrame, key: str, node: str, chunks: str) -> DataFrame:
    """Give each row of a group once per pair of chunks it takes part in: columns one, two, side."""
    own = rows.withColumn("own", F.pmod(F.xxhash64(node), F.col(chunks)).cast("int"))
    return own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(chunks).cast("int") - 1))).withColumns({
        "one": F.least("own", "other"), "two": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int"),
    }).drop("own", "other", chunks)


def signatures(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, key, packed, bands): number of shingles, hash of the set, packed minima, one hash per band."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                hashes = shingle_set(text.as_py(), width)
                if not len(hashes):
                    rows.append((0, None, None, None))
                    continue
                low = minima(hashes)
                key = np.array([mix(hashes).sum(dtype=np.uint64), mix(hashes ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)], "<u8").tobytes()
                bands = Spans(mix(low[: BANDS * ROWS])).hash(np.arange(0, BANDS * ROWS, ROWS), np.arange(ROWS, BANDS * ROWS + 1, ROWS))
                rows.append((len(hashes), key, pack(low), bands.astype(np.int64)))
            n, key, packed, bands = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(packed, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["id", "n", "key", "packed", "bands"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(sign, "id long, n long, key binary, packed binary, bands array<long>")


def families(classes: DataFrame, floor: float) -> DataFrame:
    """(node, component) of classes (node, packed, bands) that estimates hold together."""
    placed = classes.select("node", F.posexplode("bands").alias("band", "code")).select("node", F.xxhash64("band", "code").alias("bucket"))
    sizes = stage(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "mh-buckets")
    met = placed.join(sizes.withColumnRenamed("bucket", "b"), F.expr("bucket = b")).select(
        "node", "bucket", F.ceil(F.col("size") / CHUNK).alias("chunks")
    )
    cells = stage(cut_in_cells(met, "bucket", "node", "chunks"), "mh-cells")
    filled = cells.join(classes.select(F.col("node").alias("c"), "packed"), F.expr("node = c"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in groups(batches, ["bucket", "one", "two"]):
            side = cell.column("side").to_numpy()
            if cell.num_rows < 2 or cell.column("one")[0] != cell.column("two")[0] and (side.all() or not side.any()):
                continue
            packed = np.frombuffer(b"".join(cell.column("packed").to_pylist()), "<u8").reshape(cell.num_rows, -1)
            yield edges(cell.column("node").to_numpy(), *screen(packed, side, floor))

    found = (
        filled.select("bucket", "one", "two", "side", "node", "packed")
        .repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two").mapInArrow(gather, "u long, v long")
    )
    return connected_components(found)


def edges(nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """One edge per class to the least place it reaches."""
    low = least_reachable(len(nodes), i, j)
    at = np.flatnonzero(low != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(nodes[low[at]])], ["u", "v"])


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component): component is the least id reachable over links of at least ``percent``."""
    signed = stage(signatures(docs, width, id_col, text_col).dropDuplicates(["id", "key"]), "mh-signed")
    known = signed.where("n > 0 AND id IS NOT NULL")
    classes = stage(
        known.groupBy("key").agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("packed").alias("packed"), F.first("bands").alias("bands")),
        "mh-classes",
    )
    family = stage(families(classes, percent / 100 - 0.15), "mh-families")
    members = classes.select("node", "n").join(family.withColumnRenamed("node", "f"), F.expr("node = f")).select("node", "n", "component")
    members = stage(members, "mh-members")
    load = F.greatest(F.ceil(F.sum("n") / CHUNK_SHINGLES), F.ceil(F.count(F.lit(1)) / CHUNK))
    loads = members.groupBy("component").agg(load.alias("chunks"))
    placed = members.join(stage(loads.withColumnRenamed("component", "g"), "mh-loads"), F.expr("component = g")).select("node", "component", "chunks")
    cells = stage(cut_in_cells(placed, "component", "node", "chunks"), "mh-verify")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [shingle_set(t.as_py(), width).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(packed, pa.binary())], ["node", "shingles"])

    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    wanted = texts.join(members.select(F.col("node").alias("m")), F.expr("node = m"), "left_semi")
    sets = wanted.mapInArrow(sets_of, "node long, shingles binary").withColumnRenamed("node", "s").distinct()
    filled = cells.join(stage(sets, "mh-sets"), F.expr("node = s"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in groups(batches, ["component", "one", "two"]):
            side = cell.column("side").to_numpy()
            if cell.num_rows < 2 or cell.column("one")[0] != cell.column("two")[0] and (side.all() or not side.any()):
                continue
            sets = [np.frombuffer(x, np.uint64) for x in cell.column("shingles").to_pylist()]
            yield edges(cell.column("node").to_numpy(), *confirm(sets, side, percent))

    links = (
        filled.select("component", "one", "two", "side", "node", "shingles")
        .repartition("component", "one", "two").sortWithinPartitions("component", "one", "two").mapInArrow(compare, "u long, v long")
    )
    joined = connected_components(links)
    info = stage(
        classes.select(F.col("key").alias("k"), "node").join(joined.withColumnRenamed("node", "j"), F.expr("node = j"), "left")
        .select("k", F.coalesce("component", "node").alias("component")),
        "mh-info",
    )
    return signed.select("id", "n", "key").join(info, F.expr("id IS NOT NULL AND key = k"), "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component")
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one of least id.

    Rows without an id can't be told apart and stay; of rows that share an id and the text one stays.
    """
    found = near_duplicates(docs, width, percent, id_col, text_col)
    lost = stage(found.where("id <> component").select(F.col("id").alias("_lost")).distinct(), "mh-lost")
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    same = Window.partitionBy(id_col).orderBy("_mark")
    left = docs.where(F.col(id_col).isNotNull()).join(lost, F.col(id_col) == F.col("_lost"), "left_anti")
    single = left.withColumn("_mark", mark).withColumn("_before", F.lag("_mark").over(same)).where("_before IS NULL OR _before <> _mark")
    return single.select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))
