"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

Whole texts are reduced to a dozen statistics. ``cos(W x + b)`` of the standardised statistics approximates a
Gaussian kernel; each partition sums its part of the normal equations, the sums are added up by entry, and the
ridge solution scores every document. Scores are calibrated by isotonic regression over score bins, pooled by
adjacent violators. All labelled rows take part; what reaches the driver is one matrix of fixed size and one row
per score bin.

Defined results: null texts count as empty; every text, empty ones too, gets a score in [0, 1]. Null labels teach
nothing, repeated labels count as often as they stand there. Without labels of both kinds every score is the share
of label 1 (1.0 without any label: nothing speaks against a document). Rows are scored one by one, so repeated rows
repeat and an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = (
    "log_bytes", "word_bytes", "letters", "capitals", "digits", "spaces", "points", "symbols", "high_bytes",
    "distinct_words", "repeated_next", "line_words", "distinct_lines", "symbol_words",
)
# Byte classes: 0 other control, 1 small letter, 2 capital, 3 digit, 4 white space, 5 plain punctuation, 6 symbol, 7 not ASCII.
CLASSES = np.zeros(256, np.uint8)
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58], CLASSES[128:] = 1, 2, 3, 7
CLASSES[[33, 34, *range(35, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 6
CLASSES[[9, 10, 11, 12, 13, 32]] = 4
CLASSES[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = 5


def statistics(text: str | None) -> list[float]:
    """Statistics of one whole text, in the order of STATISTICS."""
    data = (text or "").encode("utf-8")
    n = max(len(data), 1)
    kinds = CLASSES[np.frombuffer(data, np.uint8)]
    counts = np.bincount(kinds, minlength=8)
    words, lines = data.split(), data.split(b"\n")
    n_words = max(len(words), 1)
    letters = counts[1] + counts[2] + counts[7]
    after_letter = np.count_nonzero((kinds[1:] == 6) & (kinds[:-1] != 4) & (kinds[:-1] != 6)) if n > 1 else 0
    return [
        float(np.log1p(len(data))), len(data) / n_words, letters / n, counts[2] / max(letters, 1), counts[3] / n,
        counts[4] / n, counts[5] / n, counts[6] / n, counts[7] / n, len(set(words)) / n_words ** 0.8,
        sum(map(eq, words, words[1:])) / n_words, float(np.log1p(len(words) / len(lines))), len(set(lines)) / len(lines),
        after_letter / n_words,
    ]


@dataclass(frozen=True)
class QualityModel:
    """Everything a worker needs to score a text; a few hundred kilobytes at most, whatever the input."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    solution: np.ndarray
    steps: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -4, 4)
        z = np.cos(x @ self.weights + self.shift) * np.sqrt(2 / self.weights.shape[1])
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.solution

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(raw, self.steps, self.values), 0, 1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        # Rounded, so that the order of the partition sums leaves no trace.
        return np.round(self.calibrated(self.raw(stats)), 6)

    def column(self, text: str = "text") -> Column:
        """Score in [0, 1] of a text column."""
        model = self

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                stats = np.array([statistics(t) for t in texts]).reshape(-1, len(STATISTICS))
                yield pd.Series(model.score(stats))

        return score(F.col(text))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats) of every row."""

    @F.pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return docs.select(F.col(id_col).alias("id"), stats(F.col(text_col)).alias("stats"))


def isotonic(raw: np.ndarray, ones: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in ascending order of score; the ends of every pool and its share of ones."""
    pools: list[list[float]] = []  # ones, count, first score, last score
    for r, y, n in zip(raw.tolist(), ones.tolist(), count.tolist(), strict=True):
        pools.append([y, n, r, r])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            y, n, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + y, pools[-1][1] + n, pools[-1][2], last]
    steps = np.array([x for p in pools for x in (p[2], p[3])])
    # Half a row of doubt at either end keeps a pool from claiming certainty.
    values = np.array([(p[0] + 0.5 * (p[0] > 0)) / (p[1] + 0.5) for p in pools]).repeat(2)
    return steps, np.maximum.accumulate(values)


def fit(
    docs: DataFrame, labels: DataFrame, features: int = 128, ridge: float = 1e-4, width: float = 3.0, bins: int = 1000,
    seed: int = 7, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> QualityModel:
    """Fit on all rows of ``docs`` that ``labels`` (id, 0/1) marks.

    The kernel is exp(-|x-y|^2 / (2 width^2)) over standardised statistics.
    """
    from clickloom.sources.stage import stage

    marks = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("double").alias("y")).where("y IS NOT NULL")
    known = stage(document_statistics(docs, id_col, text_col), "quality-stats").join(marks, F.expr("id = label_id")).select("stats", "y")
    known = stage(known, "quality-known")
    d = len(STATISTICS)
    cell = [F.col("stats")[i] for i in range(d)]
    row = known.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("y"), F.lit(1.0)).alias("y"),
        F.array(*[F.avg(c) for c in cell]).alias("mean"), F.array(*[F.stddev_pop(c) for c in cell]).alias("scale"),
    ).first()
    rng = np.random.default_rng(seed)
    weights, shift = rng.normal(size=(d, features)) / width, rng.uniform(0, 2 * np.pi, features)
    if not 0 < row["y"] < 1:
        level = float(row["y"])
        return QualityModel(np.zeros(d), np.ones(d), weights, shift, np.zeros(features + 1), np.zeros(1), np.array([level]))
    mean = np.round(np.array(row["mean"], float), 9)
    scale = np.round(np.array(row["scale"], float), 9)
    scale[scale < 1e-6] = 1
    start = QualityModel(mean, scale, weights, shift, np.zeros(features + 1), np.zeros(1), np.zeros(1))

    size = features + 1
    upper = np.triu_indices(size)

    def partition_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            y = batch.column("y").to_numpy()
            if not len(y):
                continue
            z = start.features(batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, d))
            gram += z.T @ z
            right += z.T @ y
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([upper[0], np.arange(size)]), pa.int32()),
                pa.array(np.concatenate([upper[1], np.full(size, -1)]), pa.int32()),
                pa.array(np.concatenate([gram[upper], right])),
            ],
            ["i", "j", "v"],
        )

    # One matrix of fixed size per partition; entries are added up by Spark before one matrix reaches the driver.
    sums = known.mapInArrow(partition_sums, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow().to_pandas()
    gram, right = np.zeros((size, size)), np.zeros(size)
    of_right = (sums["j"] < 0).to_numpy()
    right[sums["i"][of_right]] = sums["v"][of_right]
    i, j, v = (sums[c][~of_right].to_numpy() for c in ("i", "j", "v"))
    gram[i, j] = gram[j, i] = v
    solution = np.linalg.solve(gram + ridge * row["n"] * np.diag([1.0] * features + [0.0]) / features, right)
    scored = QualityModel(mean, scale, weights, shift, solution, np.zeros(1), np.zeros(1))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = scored.raw(batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(-1, d))
            place = np.clip(np.round(z * bins), -bins, 2 * bins).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column("y")], ["place", "y"])

    # One row per score bin.
    table = known.mapInArrow(binned, "place int, y double").groupBy("place").agg(
        F.sum("y").alias("ones"), F.count(F.lit(1)).alias("n")
    ).orderBy("place").toArrow().to_pandas()
    steps, values = isotonic(table["place"].to_numpy() / bins, table["ones"].to_numpy(), table["n"].to_numpy())
    return QualityModel(mean, scale, weights, shift, solution, steps, values)


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose score reaches the threshold."""
    return docs.where(model.column(text_col) >= F.lit(threshold))
