"""Stages kept by content: a second reader of the same table finds what the first one wrote.

A kept stage is named by a digest of the plan that reads its source (the canonical analysed plan, so column ids and
aliases of a run don't count), of the files under that plan (path, size and time of change), of the settings, and of
this library's code. Change any of them and the name changes; nothing is ever overwritten. Every writer writes a folder
of its own below that name, and readers take the first whole one, so neither a lost writer nor two at a time do harm.
"""

from __future__ import annotations

import functools
import getpass
import hashlib
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sources.stage import is_one_machine

MARK = "_SUCCESS"


def store_folder(spark: SparkSession) -> str:
    """``kept`` in the folder named by ``spark.checkpoint.dir``; where that is unset and all is one machine, a folder of
    the user that outlives the session."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/kept"
    if not is_one_machine(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return str(Path(tempfile.gettempdir()) / f"clickloom-kept-{getpass.getuser()}")


@functools.cache
def code_digest() -> str:
    """Digest of this package's sources, without the subpackage that nothing here imports."""
    package = Path(__file__).resolve().parents[1]
    digest = hashlib.sha256()
    for file in sorted(package.rglob("*.py")):
        name = file.relative_to(package)
        if name.parts[0] != "llm":
            digest.update(f"{name}\0".encode() + file.read_bytes())
    return digest.hexdigest()


def plan_text(df: DataFrame) -> str:
    """Canonical analysed plan with all of its columns."""
    spark, key = df.sparkSession, "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key)
    spark.conf.set(key, str(1 << 20))
    try:
        return df._jdf.queryExecution().analyzed().canonicalized().toString()
    finally:
        spark.conf.set(key, before)


def source_roots(df: DataFrame) -> list[str]:
    """Folders and files that the plan reads, leaf by leaf, in the order of the plan. Leaves that read no files are
    part of the plan's text."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            paths = leaf.relation().location().rootPaths()
            roots.append("|".join(paths.apply(k).toString() for k in range(paths.size())))
    return roots


def files_digest(spark: SparkSession, roots: list[str]) -> str:
    """Digest of path, size and time of change of all files below the roots. Spark lists and hashes them; one row per
    root reaches the driver."""
    out = []
    for root in dict.fromkeys(roots):
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root.split("|"))
        seen = F.sha2(F.concat_ws("|", "path", "length", "modificationTime"), 256)
        halves = [F.conv(F.substring(seen, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 16)]
        out.append(tuple(str(v) for v in listed.agg(F.count(F.lit(1)), F.sum(halves[0]), F.sum(halves[1])).first()))
    return repr(out)


def content_key(source: DataFrame, settings: object) -> str:
    roots = source_roots(source)
    parts = (plan_text(source), repr(roots), files_digest(source.sparkSession, roots), repr(settings), code_digest())
    return hashlib.sha256("\0".join(parts).encode()).hexdigest()[:32]


def whole_copies(spark: SparkSession, folder: str) -> list[str]:
    """Folders directly below ``folder`` that a writer has finished."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*/{MARK}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().getParent().toString() for f in found or [])


def kept(source: DataFrame, label: str, settings: object, build: Callable[[], DataFrame]) -> DataFrame:
    """The stage built from ``source`` under ``settings``: read if it is there, else built and written.

    ``build`` may use nothing but the rows of ``source``, ``settings`` and constants of this library; ``settings`` needs
    a ``repr`` that tells all of them apart, as dataclasses, tuples and plain values have.
    """
    spark = source.sparkSession
    folder = f"{store_folder(spark)}/{label}-{content_key(source, settings)}"
    copies = whole_copies(spark, folder)
    if not copies:
        build().write.mode("errorifexists").parquet(f"{folder}/{uuid.uuid4().hex}")
        copies = whole_copies(spark, folder)
    return spark.read.parquet(copies[0])
