"""Session helpers: build one for local work, or tune the one the cluster hands over."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime settings every job here relies on. UTC makes "local time" explicit (day and hour
# features follow the session zone); the rest lets AQE split hot join keys even when the split
# costs an extra shuffle later in the plan.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
}


def tune(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in {**RUNTIME_CONF, "spark.sql.session.timeZone": time_zone}.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "clickloom", cpus: str | int | None = None) -> SparkSession:
    """A local session for tests and benchmarks."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Hand this package to the Python workers, once per application, so that they need not find it by path."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        bundle = Path(tempfile.mkdtemp(prefix="clickloom-ship-")) / "clickloom.zip"
        with zipfile.ZipFile(bundle, "w", zipfile.ZIP_DEFLATED) as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, str(file.relative_to(package.parent)))
        context.addPyFile(str(bundle))
        _shipped.add(context.applicationId)
    return spark
