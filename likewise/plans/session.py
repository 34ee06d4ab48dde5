"""Session set-up and shared storage.

The library never builds its own session inside an operator: callers pass
``spark``.  ``local_session`` exists for tests and the bench only.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package relies on.  AQE re-plans joins and
# coalesces small shuffle partitions at run time; its skew-join rule splits a
# shuffle partition that one hot key has made much larger than the median.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "likewise") -> SparkSession:
    """A ``local[cores]`` session for tests and benchmarks."""
    parts = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(parts))
               .config("spark.driver.memory", "16g"))
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether all tasks run in the driver's own process."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared file system path and
    is used as it is.  Only when it is unset and the master is local (tests on
    one machine) a fresh folder is created and registered; on any other master
    a RuntimeError is raised, as executors would not share such a folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions expose no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not is_local(master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master!r}")
        configured = tempfile.mkdtemp(prefix="likewise-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared checkpoint folder.

    Tables that cut lineage or hold intermediate results go here, never to a
    machine-local temporary folder.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/likewise/{name}-{uuid.uuid4().hex}"


_owners: ContextVar[tuple["OwnedTables", ...]] = ContextVar("likewise-owners", default=())


class OwnedTables:
    """The intermediate tables written in a ``with`` block, deleted when it ends.

    What the block makes must be written or collected in it, as its plan reads the tables.
    ``keep`` writes a DataFrame as a table that outlives the block (it then belongs to the
    enclosing block, if there is one).  Blocks nest; each owns what is written in it and not
    in an inner one.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> "OwnedTables":
        self._token = _owners.set((*_owners.get(), self))
        return self

    def __exit__(self, *_error) -> None:
        _owners.reset(self._token)
        for path in self.paths:
            delete_path(self.spark, path)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        outer = _owners.get()[:-1]
        token = _owners.set(outer)
        try:
            return materialize(df, name)
        finally:
            _owners.reset(token)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table of this package's by the file system it is in."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: later steps
    start from stored files, so a lost executor costs a re-read.  The table belongs to the
    innermost ``OwnedTables`` block; without one it stays until the folder is cleared."""
    path = shared_path(df.sparkSession, name)
    owners = _owners.get()
    if owners:
        owners[-1].paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers: its
    sources go as a zip into the shared folder, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    path = sc._jvm.org.apache.hadoop.fs.Path(shared_path(spark, "package") + "/likewise.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(path.toString())
    _shipped.add(sc.applicationId)
