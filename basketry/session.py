"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs a later re-shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan here relies on."""
    for key, value in RUNTIME_CONFS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONFS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give this package's source to all executors, once for each application; Python tasks need it there."""
    context = spark.sparkContext
    if getattr(context, "_basketry_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="basketry-")).resolve() / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._basketry_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a temporary one in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="basketry-checkpoint-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """The path of a new folder in the checkpoint folder; it goes away when the application ends."""
    path = f"{checkpoint_dir(spark)}/basketry-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)  # only what exists can be marked
    files.deleteOnExit(folder)
    return path


def cut_lineage(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once as parquet in the checkpoint folder and read it back. Runs a Spark job.

    Later passes then scan only the columns they need, and survive lost executors. The copy goes away
    when the application ends.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/rows"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows up to which a lookup side may be broadcast.
LOOKUP_ROWS = 50_000


def lookup(df: DataFrame, limit: int = LOOKUP_ROWS) -> tuple[DataFrame, bool]:
    """A stored copy of a lookup side, and whether its rows, counted in the copy, may be broadcast.

    Runs Spark jobs. A longer side stays a plain join side, which Spark shuffles with skew handling.
    """
    stored = cut_lineage(df)
    return stored, stored.limit(limit + 1).count() <= limit


def hinted(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df
