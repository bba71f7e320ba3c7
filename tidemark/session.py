"""Session helpers: a tuned builder, and the durable folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def build_session(
    app: str = "tidemark", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with AQE, skew splitting and UTC; ``conf`` overrides any setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot partition even where that costs one more exchange.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.checkpoint.compress": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def durable_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a missing setting is an error, because executors could not share it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tidemark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path for one run under the durable folder."""
    return f"{durable_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so later passes read the same rows.

    Written as a Parquet table: later passes prune columns and know its size. Types
    that Parquet cannot hold go through a reliable checkpoint instead.
    """
    if _storable(df.schema):
        path = fresh_path(df.sparkSession, "cut")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    durable_root(df.sparkSession)
    return df.checkpoint(eager=True)


def _storable(schema: T.StructType) -> bool:
    names = [n.lower() for n in schema.names]
    text = schema.simpleString()
    return len(names) > 0 and len(set(names)) == len(names) and not any(
        kind in text for kind in ("void", "interval", "variant")
    )


def widen(scan: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than the cluster has cores.

    For costly per-row work on few files; a large scan already has more splits and is
    returned as it is. ``scan`` must be a plain scan, without shuffles.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
