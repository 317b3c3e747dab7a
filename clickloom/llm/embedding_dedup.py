"""Embedding near-dedup: random-hyperplane signs in several tables, exact cosines, connected components.

Equal vectors of a label are one class. Each class is put into one bucket per table, by label and the signs of its
products with the table's hyperplanes. Buckets of one class are dropped; a large bucket is cut into chunks of
CHUNK classes, and each pair of chunks is a cell of its own, so no task holds more than two chunks of a bucket.
A cell compares its classes by one matrix product in double precision and returns a number of links per class and
one edge per class to the least class it reaches in the cell: never a row per pair. A pair that meets in several
tables counts in the first.

With ``bits`` = 12 and ``tables`` = 24 a pair at cosine 0.93 shares a table with probability 0.997, a closer pair
with more. Links found are exact.

Defined results: a vector that is null, all zero, or holds null or non-finite components, or whose label is null, has
no links and is its own component. Vectors of different length never link. Rows that repeat id, label and vector
count once. An empty table stays empty; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import connected_components
from clickloom.sources.stage import stage

CHUNK = 256


def hyperplanes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).normal(size=(dim, tables * bits))


def sign_codes(vectors: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """(rows, tables) integers made of the signs against each table's hyperplanes."""
    signs = (vectors @ hyperplanes(vectors.shape[1], tables, bits, seed) >= 0).reshape(len(vectors), tables, bits)
    return signs @ (1 << np.arange(bits))


def link_cell(vectors: np.ndarray, codes: np.ndarray, side: np.ndarray, table: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a cell at or above the threshold that share no earlier table.

    ``side`` is 0 or 1; a cell of two chunks compares across them, a cell of one chunk within it.
    """
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    unit = vectors / norms[:, None]
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if side.any() else left
    i, j = np.nonzero(unit[left] @ unit[right].T >= threshold - 1e-9)
    i, j = left[i], right[j]
    if right is left:
        i, j = i[i < j], j[i < j]
    keep = np.empty(len(i), bool)
    for start in range(0, len(i), 1 << 16):
        a, b = i[start : start + (1 << 16)], j[start : start + (1 << 16)]
        cosine = np.einsum("ij,ij->i", vectors[a], vectors[b]) / (norms[a] * norms[b])
        earlier = (codes[a, :table] == codes[b, :table]).any(1) if table else False
        keep[start : start + (1 << 16)] = (cosine >= threshold) & ~np.asarray(earlier)
    return i[keep], j[keep]


def least_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n places the least place it can reach over the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(k).to_numpy() for k in keys])
        cuts = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(0)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            key = tuple(columns[:, start])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def near_duplicates(
    rows: DataFrame, threshold: float = 0.93, tables: int = 24, bits: int = 12, seed: int = 11, id_col: str = "vec_id",
    vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(id, n_links, component): one row per distinct (id, label, vector)."""
    vector = F.col(vector_col).cast("array<double>")
    usable = (
        F.col(label_col).isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    )
    distinct = stage(
        rows.select(
            F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), vector.alias("vector"), usable.alias("usable"),
            F.md5(F.to_json(F.struct(F.col(label_col).alias("l"), vector.alias("v"))).cast("binary")).alias("key"),
        ).dropDuplicates(["id", "key"]),
        "emb-rows",
    )
    classes = stage(
        distinct.where("usable").groupBy("key").agg(
            F.min("id").alias("node"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("vector").alias("vector")
        ),
        "emb-classes",
    )

    def codes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            sizes = lists.value_lengths().to_numpy()
            flat = lists.flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                for part in np.array_split(at, 1 + len(at) // 4096):
                    vectors = flat[starts[part][:, None] + np.arange(dim)]
                    # Scaled, so that neither huge nor tiny components overflow or vanish.
                    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
                    codes = sign_codes(vectors, tables, bits, seed).astype("<i4")
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("node").take(pa.array(part)), batch.column("n").take(pa.array(part)),
                            batch.column("label").take(pa.array(part)), pa.array(np.full(len(part), dim, np.int32)),
                            pa.array([v.tobytes() for v in vectors]), pa.array([c.tobytes() for c in codes]),
                            pa.array(list(codes), pa.list_(pa.int32())),
                        ],
                        ["node", "n", "label", "dim", "data", "packed", "codes"],
                    )

    coded = stage(
        classes.select("node", "n", "label", "vector")
        .mapInArrow(codes_of, "node long, n long, label string, dim int, data binary, packed binary, codes array<int>"),
        "emb-codes",
    )
    placed = coded.select("node", "label", "dim", F.posexplode("codes").alias("tab", "code")).select(
        "node", "tab", F.xxhash64("label", "dim", "tab", "code").alias("bucket")
    )
    sizes = stage(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "emb-buckets")
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    cells = (
        placed.join(sizes.withColumnRenamed("bucket", "b"), F.expr("bucket = b"))
        .withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "node", "tab", "bucket", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
        )
    )
    cells = stage(cells, "emb-cells")
    filled = cells.join(coded.select(F.col("node").alias("c"), "n", "data", "packed"), F.expr("node = c")).drop("c")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in groups(batches, ["bucket", "one", "two"]):
            if cell.num_rows < 2:
                continue
            table = cell.column("tab")[0].as_py()
            side = cell.column("side").to_numpy()
            if cell.column("one")[0] != cell.column("two")[0] and (side.all() or not side.any()):
                continue
            vectors = np.stack([np.frombuffer(x, "<f8") for x in cell.column("data").to_pylist()])
            codes = np.stack([np.frombuffer(x, "<i4") for x in cell.column("packed").to_pylist()])
            i, j = link_cell(vectors, codes, side, table, threshold)
            if not len(i):
                continue
            nodes, n = cell.column("node").to_numpy(), cell.column("n").to_numpy()
            links = np.bincount(i, n[j], len(nodes)) + np.bincount(j, n[i], len(nodes))
            at = np.flatnonzero(links)
            low = least_reachable(len(nodes), i, j)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[at]), pa.array(links[at].astype(np.int64)), pa.array(nodes[low[at]])], ["node", "links", "to"]
            )

    found = stage(
        filled.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two")
        .select("bucket", "one", "two", "side", "tab", "node", "n", "data", "packed")
        .mapInArrow(compare, "node long, links long, to long"),
        "emb-links",
    )
    joined = connected_components(found.select(F.col("node").alias("u"), F.col("to").alias("v")))
    links = found.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "l")
    info = stage(
        classes.select("key", "node", "n").join(links, F.expr("node = l"), "left")
        .join(joined.withColumnRenamed("node", "j"), F.expr("node = j"), "left")
        .select(
            F.col("key").alias("k"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "emb-info",
    )
    return distinct.select("id", "usable", "key").join(info, F.expr("usable AND key = k"), "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component")
    )
