"""Document fingerprints: a Merkle tree over paragraphs and sections, with DataFrame functions only.

A paragraph is a piece of the text, cut by content: it ends with line ends, or, once LEAST code points long, with sentence
marks or where a code point comes again two or three places on; after PIECE code points if none of these is met. The
pieces make up the whole text. A section ends with a paragraph whose hash starts with the digit 0, one in sixteen, or with the text. So
an insertion moves no cuts but those close to it, in any script. Paragraphs are hashed, sections hash the hashes of
their paragraphs, the root hashes the sections. The fingerprint names the root and, section by section, the first
eight digits of every paragraph's hash: equal roots mean equal texts; ``differences`` descends from differing roots
to the sections and paragraphs that differ.

Defined results: a null text counts as empty; the empty text has no sections and a root of its own. ``likeness`` is 1
for equal roots, else twice the number of common distinct paragraphs over the sum of both numbers, 0 if none.
``with_next`` orders rows by id and, among equal ids, by text (nulls first); the last row is followed by the first,
a single row by itself; an empty table stays empty. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST = 24
PIECE = 160
# Sentence marks of Arabic, Indic, Ethiopic, Armenian and East Asian scripts, looked up for code points beyond Latin-1 only:
# Java tries such a list one by one, which for every letter of a text costs more than all else together.
MARKS = r"\u2026\u3002\uFF01\uFF0E\uFF1F\uFF61\u061F\u06D4\u0964\u0965\u1362\u1367\u0589"
# Code points met by one block of rows in ``with_next``, and the most blocks that the driver keeps bounds of.
BLOCK_CHARS = 1 << 25
BLOCKS = 20_000
PARAGRAPH = (
    rf"[^\n]{{0,{LEAST - 2}}}+\n+"
    rf"|[^\n]{{{LEAST - 1},{PIECE - 1}}}?(?:[\n.!?]+|(?![\x00-\xFF])[{MARKS}]|([^\n])(?=[^\n]{{1,2}}\1))"
    rf"|[^\n]{{1,{PIECE}}}"
)


def pieces(text: Column) -> Column:
    """Paragraphs of a text, in order; no code point is left out."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))


def by_section(leaf: Column, item: Column) -> Column:
    """``item`` (an array as long as the paragraph hashes ``leaf``) in sections: an array of arrays."""
    places = F.transform(leaf, lambda h, i: F.when(h.startswith("0") | (i == F.size(leaf) - 1), i + 1))

    def cut(ends: Column) -> Column:
        def section(end: Column, k: Column) -> Column:
            start = F.when(k > 0, F.get(ends, k - 1)).otherwise(0)
            return F.slice(item, start + 1, end - start)

        return F.transform(ends, section)

    return F.element_at(F.transform(F.array(F.array_compact(places)), cut), 1)


def fingerprint(text: Column) -> Column:
    """``root:paragraph.paragraph/paragraph...`` of a text column, ``/`` between sections."""
    leaves = F.transform(pieces(text), lambda p: F.md5(p.cast("binary")))

    def tree(sections: Column) -> Column:
        root = F.sha2(F.array_join(F.transform(sections, lambda s: F.md5(F.array_join(s, "").cast("binary"))), "").cast("binary"), 256)
        shown = F.transform(sections, lambda s: F.array_join(F.transform(s, lambda h: F.substring(h, 1, 8)), "."))
        return F.concat(root, F.lit(":"), F.array_join(shown, "/"))

    # Bound once by one-element transforms, so that the text is not cut again for every use.
    sections = F.transform(F.array(leaves), lambda leaf: F.when(F.size(leaf) > 0, by_section(leaf, leaf)))
    empty = F.concat(F.sha2(F.lit("").cast("binary"), 256), F.lit(":"))
    return F.coalesce(F.element_at(F.transform(sections, lambda s: F.when(s.isNotNull(), tree(s))), 1), empty)


def paragraph_at(text: Column, section: Column, paragraph: Column) -> Column:
    """The paragraph at a place that ``differences`` names, both numbers from 1; null where there is none."""
    cut = F.transform(F.array(pieces(text)), lambda p: by_section(F.transform(p, lambda x: F.md5(x.cast("binary"))), p))
    return F.get(F.get(F.element_at(cut, 1), section - 1), paragraph - 1)


def sections(print_: Column) -> Column:
    """Sections of a fingerprint, each with its paragraphs' hashes."""
    shown = F.substring_index(print_, ":", -1)
    return F.when(shown == "", F.array().cast("array<string>")).otherwise(F.split(shown, "/"))


def differences(pairs: DataFrame, a: str = "fingerprint", b: str = "edited_fingerprint", id_col: str = "id") -> DataFrame:
    """(id, side, section, paragraph, hash): where the texts of two fingerprint columns differ, from the fingerprints alone.

    Equal roots have no rows. Of differing roots the sections are compared, and only sections that one side (``a`` or
    ``b``) has alone are opened; a paragraph in them that no opened section of the other side holds has a row. An opened
    section without such a paragraph differs in the order or the number of its paragraphs: one row, paragraph null. If
    no section stands alone, the order or number of sections differs: one row, side and section null too. Rows that
    repeat id and both fingerprints count once; pairs with a null fingerprint have no rows.
    """
    key = F.concat_ws(":", F.col(id_col).isNull().cast("string"), F.col(id_col).cast("string"), root(F.col(a)), root(F.col(b)))
    unequal = pairs.where(root(F.col(a)) != root(F.col(b))).select(F.col(id_col).alias("id"), key.alias("pair"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    unequal = unequal.dropDuplicates(["pair"])
    sides = F.explode(F.array(*[F.struct(F.lit(x).alias("side"), sections(F.col(f"_{x}")).alias("sections")) for x in ("a", "b")]))
    rows = unequal.select("id", "pair", sides.alias("s")).select("id", "pair", "s.side", F.posexplode("s.sections").alias("at", "hash"))

    def alone(level: DataFrame) -> DataFrame:
        one_side = level.groupBy("pair", "hash").agg(F.min("side").alias("x"), F.max("side").alias("y")).where("x = y")
        return level.join(one_side, ["pair", "hash"], "left_semi")

    opened = alone(rows).select("id", "pair", "side", (F.col("at") + 1).alias("section"), F.col("hash").alias("shown"))
    changed = alone(
        opened.select("id", "pair", "side", "section", F.posexplode(F.split("shown", "[.]")).alias("at", "hash"))
    ).withColumn("paragraph", F.col("at") + 1)
    nothing = F.lit(None)
    moved = opened.join(changed, ["pair", "side", "section"], "left_anti").withColumns(
        {"paragraph": nothing.cast("int"), "hash": nothing.cast("string")})
    shuffled = unequal.join(opened, "pair", "left_anti").withColumns(
        {"side": nothing.cast("string"), "section": nothing.cast("int"), "paragraph": nothing.cast("int"), "hash": nothing.cast("string")})
    columns = ("id", "side", "section", "paragraph", "hash")
    return changed.select(*columns).unionByName(moved.select(*columns)).unionByName(shuffled.select(*columns))


def root(print_: Column) -> Column:
    return F.substring_index(print_, ":", 1)


def paragraphs(print_: Column) -> Column:
    """Distinct paragraph hashes of a fingerprint."""
    shown = F.substring_index(print_, ":", -1)
    return F.when(shown == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(shown, "[./]")))


def likeness(a: Column, b: Column) -> Column:
    def compare(pair: Column) -> Column:
        both = F.size(pair["a"]) + F.size(pair["b"])
        return F.coalesce(2.0 * F.size(F.array_intersect(pair["a"], pair["b"])) / F.nullif(both, F.lit(0)), F.lit(0.0))

    pairs = F.transform(F.array(F.struct(paragraphs(a).alias("a"), paragraphs(b).alias("b"))), compare)
    return F.when(root(a) == root(b), 1.0).otherwise(F.element_at(pairs, 1))


def with_next(docs: DataFrame, value_cols: tuple[str, ...], id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Add ``next_<c>`` for each of ``value_cols``: its value in the following row.

    Rows are cut into blocks by quantiles of the id, two a shuffle partition or more, so that a block holds some
    BLOCK_CHARS of text; the bounds, at most BLOCKS, are all that reaches the driver. Each block also gets the first rows
    of the next one as guests, so one shuffle of the rows is enough. Rows of one id stay in a block, which is sorted and
    read with spilling, never held whole.
    """
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length(text_col)).alias("n")).first()["n"] or 0
    wanted = min(BLOCKS, max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // BLOCK_CHARS)))
    shares = [i / wanted for i in range(1, wanted)]
    bounds = docs.agg(F.percentile_approx(id_col, shares, 20 * wanted).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def block(value: Column) -> Column:
        """Number of bounds that are not above the value, found in two steps; 0 for null."""
        if not groups:
            return F.lit(0)
        firsts = F.array(*[F.lit(g[0]) for g in groups])
        inner = F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups])
        at = F.size(F.filter(firsts, lambda b: b <= value))
        within = F.size(F.filter(F.element_at(inner, F.greatest(at, F.lit(1))), lambda b: b <= value))
        return F.when(value.isNull() | (at == 0), 0).otherwise((at - 1) * step + within)

    placed = docs.withColumn("_block", block(F.col(id_col)))
    # One row per block.
    firsts = sorted(
        (r["_block"], r["first"] is None, r["first"] or 0)
        for r in docs.select(block(F.col(id_col)).alias("_block"), id_col)
        .groupBy("_block").agg(F.min(F.struct(id_col)).getField(id_col).alias("first")).collect()
    )
    guests = placed.limit(0).withColumn("_guest", F.lit(1))
    if firsts:
        follow = [(f[2] if not f[1] else None, firsts[i - 1][0]) for i, f in enumerate(firsts)]
        hosts = spark.createDataFrame(follow, "_id long, _host int")
        # Rows that open a block: at most one id per block, the table of hosts is as small.
        ids = [i for i, _ in follow if i is not None]
        opening = docs.where(F.col(id_col).isin(ids) | F.col(id_col).isNull())
        guests = (
            opening.join(F.broadcast(hosts), F.col(id_col).eqNullSafe(F.col("_id")))
            .groupBy(F.col("_host").alias("_block"))
            .agg(F.min_by(F.struct(*docs.columns), F.struct(text_col)).alias("_row"))
            .select("_row.*", "_block", F.lit(1).alias("_guest"))
        )
    # The guest of the last block opens the first one, so guests sort by their flag, not by id.
    window = Window.partitionBy("_block").orderBy("_guest", id_col, text_col)
    # As many partitions as blocks asked for: a session's own number would let a task's share grow with the rows.
    rows = placed.withColumn("_guest", F.lit(0)).unionByName(guests).repartition(wanted, "_block")
    nexts = {f"next_{c}": F.lead(c).over(window) for c in value_cols}
    return rows.withColumns(nexts).where("_guest = 0").drop("_block", "_guest")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited, fingerprint, next_fingerprint): ``edited`` swaps the second half for the next text's start."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    followed = with_next(rows.withColumn("print", fingerprint(F.col("text"))), ("text", "print"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) AS int))"), F.left("next_text", half))
    return followed.select(
        "id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), F.col("print").alias("fingerprint"),
        F.col("next_print").alias("next_fingerprint"),
    )
