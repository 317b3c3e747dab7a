"""URL filters: host and path rules, and for the rest naive Bayes over segmented host names and path tokens.

Host names are concatenated words. Each run of letters of a distinct host is split by Viterbi search under a unigram
model: the known substrings of a run are found by a join with the counted words, and only a run's own substrings
meet in one place. The words come from the titles of all pages, whatever their length.
Multinomial naive Bayes is trained on the pages the rules judge and scores all pages by joins and sums.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and, having no tokens, is
allowed, as is any page whose score is not above zero. Repeated rows are judged alike and stay; an empty table
stays empty. Without any page that the rules judge every page is allowed. Of the table only id, url and the title are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.sources.stage import stage

# (verdict, host, path): fixed values of the registered query.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), letters, letters.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], part: int) -> Column:
    """Rule text (part 1) or verdict (part 0) of the longest fitting rule, else null."""
    out = F.lit(None).cast("string")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, verdict if part == 0 else name + start).otherwise(out)
    return out


def path_tokens(path: Column) -> Column:
    """Runs of letters in lower case, and ``#`` for a run of digits."""
    return F.transform(F.regexp_extract_all(F.lower(path), F.lit(r"\p{L}+|[0-9]+"), 0), lambda t: F.when(t.rlike("^[0-9]"), "#").otherwise(t))


def split_words(run: str, words: list[str], logs: list[float], unknown: float) -> list[str]:
    """The likeliest way to cut ``run`` into words; a piece outside the known words costs ``unknown`` and 2.3 a letter.

    Known pieces are tried up to the longest word that the run holds, unknown ones of any length: as their cost is linear,
    the best start of one is kept from letter to letter.
    """
    known = dict(zip(words, logs, strict=True))
    longest = max(map(len, words), default=0)
    best, cut = [0.0], [0]
    start, value = 0, 0.0  # of the best unknown piece that ends here: its start, and what is gained before it
    for end in range(1, len(run) + 1):
        top, at = value + unknown - 2.3 * end, start
        for begin in range(max(0, end - longest), end):
            gain = known.get(run[begin:end])
            if gain is not None and best[begin] + gain > top:
                top, at = best[begin] + gain, begin
        best.append(top)
        cut.append(at)
        if top + 2.3 * end > value:
            start, value = end, top + 2.3 * end
    out, end = [], len(run)
    while end:
        out.append(run[cut[end] : end])
        end = cut[end]
    return out[::-1]


def segment(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """(host, tokens) for distinct hosts, given (word, n) counts."""
    counts = words.agg(F.sum("n").alias("n"), F.max(F.length("word")).alias("longest")).first()
    total, longest = max(counts["n"] or 0, 1), counts["longest"] or 1
    runs = stage(
        hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit(r"\p{L}+|[0-9]+"), 0)).alias("place", "run"))
        .select("host", "place", F.when(F.col("run").rlike("^[0-9]"), "#").otherwise(F.col("run")).alias("run")),
        "url-runs",
    )
    distinct = stage(runs.where("run <> '#'").select("run").distinct(), "url-distinct")
    starts = F.explode(F.sequence(F.lit(1), F.length("run")))
    lengths = F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("run") - F.col("start") + 1)))
    pieces = (
        distinct.withColumn("start", starts).withColumn("size", lengths)
        .select("run", F.expr("substring(run, start, size)").alias("piece")).distinct()
    )
    known = (
        stage(pieces, "url-pieces").join(words, F.expr("piece = word"))
        .groupBy(F.col("run").alias("k")).agg(F.collect_list("piece").alias("words"), F.collect_list(F.log(F.col("n") / total)).alias("logs"))
    )
    unknown = -math.log(total) + 2.3

    @F.pandas_udf("array<string>")
    def cut(run: pd.Series, words: pd.Series, logs: pd.Series) -> pd.Series:
        rows = zip(run, words, logs, strict=True)
        return pd.Series([split_words(r, [] if w is None else list(w), [] if x is None else list(x), unknown) for r, w, x in rows], dtype=object)

    cuts = stage(
        distinct.join(stage(known, "url-known"), F.expr("run = k"), "left").select(F.col("run").alias("k"), cut("run", "words", "logs").alias("tokens")),
        "url-cuts",
    )
    return runs.join(cuts, F.expr("run = k"), "left").groupBy("host").agg(
        F.flatten(F.collect_list(F.coalesce("tokens", F.array("run")))).alias("tokens")
    )


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(id, host, path, rule, verdict, score): ``score`` is the log odds for blocking, null where a rule decides."""
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")).withColumns({
        "rule": rule_of(F.col("host"), F.col("path"), rules, 1), "ruled": rule_of(F.col("host"), F.col("path"), rules, 0),
        "row": F.monotonically_increasing_id(),
    })
    rows = stage(rows, "url-rows")
    title = F.regexp_extract(F.col(html_col), r"(?is)<title[^>]*>(.*?)</title>", 1)
    words = pages.select(F.explode(F.regexp_extract_all(F.lower(title), F.lit(r"\p{L}+"), 0)).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    hosts = stage(segment(stage(rows.select("host").where("host <> ''").distinct(), "url-hosts"), stage(counted, "url-words")), "url-segments")

    tokens = rows.join(hosts.withColumnRenamed("host", "h"), F.expr("host = h"), "left").select(
        "row", "ruled", F.explode(F.concat(F.coalesce("tokens", F.array().cast("array<string>")), path_tokens(F.col("path")))).alias("token")
    )
    tokens = stage(tokens, "url-tokens")
    blocked, allowed = F.count(F.when(F.col("ruled") == "block", 1)), F.count(F.when(F.col("ruled") == "allow", 1))
    counts = stage(tokens.groupBy("token").agg(blocked.alias("b"), allowed.alias("a")), "url-counts")
    sums = counts.agg(F.sum("b").alias("b"), F.sum("a").alias("a"), F.count(F.lit(1)).alias("v")).first()
    n_b, n_a, n_v = sums["b"] or 0, sums["a"] or 0, max(sums["v"] or 0, 1)
    odds = F.log((F.col("b") + 1) / (n_b + n_v)) - F.log((F.col("a") + 1) / (n_a + n_v))
    weights = stage(counts.select(F.col("token").alias("t"), F.round(odds, 9).alias("odds")), "url-weights")
    ruled = rows.agg(F.count(F.when(F.col("ruled") == "block", 1)).alias("b"), F.count(F.when(F.col("ruled") == "allow", 1)).alias("a")).first()
    prior = math.log((ruled["b"] + 1) / (ruled["a"] + 1))
    scores = (
        tokens.where("ruled IS NULL").join(weights, F.expr("token = t"))
        .groupBy(F.col("row").alias("r")).agg(F.round(F.sum(F.col("odds").cast("decimal(28,9)")).cast("double") + prior, 6).alias("score"))
    )
    judged = rows.join(stage(scores, "url-scores"), F.expr("row = r"), "left")
    verdict = F.coalesce("ruled", F.when(F.col("score") > 0, "block").otherwise("allow"))
    return judged.select("id", "host", "path", "rule", verdict.alias("verdict"), "score")
