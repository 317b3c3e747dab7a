"""Language identification by compression.

Each learned language has a raw-content zstandard dictionary made of excerpts. A text is compressed with every
dictionary; the language whose dictionary gives the fewest bytes wins. ``score`` is the margin to the runner-up,
as a share of the runner-up's bytes; below ``min_margin`` the operator rejects the text.

The dictionaries come from a bounded sample, which is a documented parameter: of the labelled rows of a language
at most ``slots`` documents (the one of lowest hash in each of so many hash slots), together at most
``dictionary_bytes``. One dictionary per language goes to every worker; languages are few by nature.

Defined results: null texts and texts without a letter get ``und`` and score 0; so does every text if nothing was
learned. Ties go to the language with more labelled rows, then to the smaller name. Null languages teach nothing.
Texts are judged whole, row by row: repeated rows repeat, an empty table stays empty, other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
RESULT = "lang_pred string, score double, rejected boolean"


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries in order of preference for ties."""

    dictionaries: tuple[tuple[str, bytes], ...]
    level: int = 6
    min_margin: float = 0.02

    def compressors(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        out = []
        for lang, data in self.dictionaries:
            content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=self.level)
            out.append((lang, zstandard.ZstdCompressor(level=self.level, dict_data=content, write_content_size=False)))
        return out

    def judge(self, text: str | None, compressors: list) -> tuple[str, float, bool]:
        if not compressors or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        data = text.lower().encode("utf-8")
        sizes = [len(c.compress(data)) for _, c in compressors]
        best = min(sizes)
        lang = compressors[sizes.index(best)][0]
        if len(sizes) == 1:
            return lang, 1.0, False
        second = sorted(sizes)[1]
        score = (second - best) / second
        return lang, score, score < self.min_margin

    def column(self, text: str = "text") -> Column:
        """Struct column (lang_pred, score, rejected) for a text column."""
        model = self

        @F.pandas_udf(RESULT)
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            compressors = model.compressors()
            for texts in batches:
                yield pd.DataFrame(
                    [model.judge(t, compressors) for t in texts], columns=["lang_pred", "score", "rejected"]
                )

        return predict(F.col(text))


def fit(
    docs: DataFrame, slots: int = 64, dictionary_bytes: int = 64 << 10, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", level: int = 6, min_margin: float = 0.02,
) -> LanguageModel:
    """Learn from rows with text and language. Which rows are sampled depends on their ids alone."""
    rows = docs.select(
        F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col)).alias("h"),
    ).where("lang IS NOT NULL AND length(text) > 0")
    # One row per language and slot: a partial aggregate, so a language with most rows costs no task more.
    picked = rows.groupBy("lang", F.pmod("h", F.lit(slots)).alias("slot")).agg(
        F.min(F.struct("h", "id")).alias("first"), F.count(F.lit(1)).alias("n")
    ).collect()
    totals: dict[str, int] = {}
    chosen: dict[str, set] = {}
    for r in picked:
        totals[r["lang"]] = totals.get(r["lang"], 0) + r["n"]
        chosen.setdefault(r["lang"], set()).add(r["first"]["id"])
    if not totals:
        return LanguageModel((), level, min_margin)
    ids = {i for some in chosen.values() for i in some if i is not None}
    excerpts = (
        rows.where(F.col("id").isin(list(ids))).select("lang", "h", "id", F.substring("text", 1, dictionary_bytes).alias("text"))
        .groupBy("lang", "h", "id").agg(F.min("text").alias("text")).collect()  # at most slots rows a language
    )
    found: dict[str, list] = {}
    for r in sorted(excerpts, key=lambda r: (r["h"], r["text"])):
        if r["id"] in chosen[r["lang"]]:
            found.setdefault(r["lang"], []).append(r["text"].lower().encode("utf-8"))
    dictionaries = []
    for lang in sorted(found, key=lambda x: (-totals[x], x)):
        share = max(1 << 10, dictionary_bytes // len(found[lang]))
        data = b"\n".join(t[:share] for t in found[lang])[:dictionary_bytes]
        if len(data) >= 8:  # shorter content is no dictionary
            dictionaries.append((lang, data))
    return LanguageModel(tuple(dictionaries), level, min_margin)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``language`` (lang_pred, score, rejected); one of that name is replaced."""
    return docs.withColumn("language", model.column(text_col))
