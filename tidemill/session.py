"""Session settings and shared storage.

Nothing here assumes a local file system: intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir``. Only where that is unset (tests, a laptop) a temporary folder is made.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on: UTC, AQE with skew handling, Arrow."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.ui.enabled": "false",
    }
    spark = b.config(map=settings | conf).getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, so that their Python workers find it wherever it lies on the driver."""
    import tidemill

    home = Path(tidemill.__file__).resolve().parent
    # the driver serves the archive to executors that come later, so it is kept
    spark.sparkContext.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/tidemill", "zip", home.parent, home.name))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; made up (and set as checkpoint folder) only where none is configured."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        sc = spark.sparkContext
        current = sc._jsc.sc().getCheckpointDir()
        if not current.isDefined() and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        known = current.get() if current.isDefined() else tempfile.mkdtemp(prefix="tidemill-")
        spark.conf.set("spark.checkpoint.dir", known)
        if not current.isDefined():
            sc.setCheckpointDir(known)
    return known.rstrip("/")


class Scratch:
    """Tables written to the shared folder, to cut lineage in a way that survives the loss of executors.

    ``keep`` writes a frame and returns it as read back; ``drop`` removes a table that no later step reads.
    Iterative operators drop the previous round's table as soon as the next one is written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.n = spark, 0
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:04d}"
        schema = df.schema
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_scratch_path", None)
        if path:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
