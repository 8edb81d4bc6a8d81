"""Spark sessions and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def local_session(cpus: int | str = "*", app: str = "lontar", **conf: str) -> SparkSession:
    """A local session with the settings the engine is tuned for: UTC and AQE on."""
    os.environ.setdefault("TZ", "UTC")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    defaults = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    for key, value in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each application; they need not have it on their path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    name = os.path.join(tempfile.mkdtemp(prefix="lontar-ship-"), "lontar_package.zip")
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``. Where that is unset a local session gets a temporary one; on a
    cluster it is an error, as no executor could read another machine's folder."""
    have = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if have:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(have)
        return have
    current = sc._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lontar-checkpoint-"))
        current = sc._jsc.sc().getCheckpointDir()
    return current.get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _bytes(df: DataFrame) -> Column:
    """About the bytes of a row: eight for each value, and the lengths of strings, binaries and lists."""
    size = F.lit(8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        kind, c = f.dataType.simpleString(), F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind in ("array<string>", "array<binary>"):
            size = size + F.coalesce(F.aggregate(c, F.lit(0), lambda n, x: n + 8 + F.coalesce(F.octet_length(x), F.lit(0))), F.lit(0))
        elif kind.startswith("array"):
            size = size + 8 * F.coalesce(F.size(c), F.lit(0))
    return size


def small_side(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20) -> DataFrame:
    """``df``, materialised, with a broadcast hint only if its counted rows and bytes are at most these; else it joins by shuffle."""
    kept = cut(df)
    rows, size = kept.agg(F.count("*"), F.coalesce(F.sum(_bytes(kept)), F.lit(0))).first()
    return F.broadcast(kept) if rows <= max_rows and size <= max_bytes else kept
