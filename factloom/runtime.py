"""What every operator needs from the session: tables, a shared folder, partition counts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of the data set in ``root``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    """Partitions for a shuffle: what the session sets for SQL shuffles."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    It is ``spark.checkpoint.dir`` where the session has one. Where it is unset, a temporary folder is made on one machine; a
    cluster, whose executors wouldn't share it, raises.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        named = sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="factloom-")
        atexit.register(shutil.rmtree, named, True)
        sc.setCheckpointDir(named)
    return named.rstrip("/")


#: Whether Spark removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, tidy: bool = False) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Cuts the lineage with files that outlive a lost executor. The files go with ``free``, or when the program ends.
    ``tidy`` removes what was shuffled for it at once, where Spark would keep it until it collects garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/factloom-stage-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, str(tidy or before == "true").lower())
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _paths.append(path)
    if len(_paths) == 1:
        atexit.register(free, spark)
    return spark.read.schema(df.schema).parquet(path)


#: Staged tables that are still there.
_paths: list[str] = []


def mark() -> int:
    """The staged tables there are, to be given to ``free``."""
    return len(_paths)


def free(spark: SparkSession, since: int = 0) -> None:
    """Remove the tables staged after ``mark`` gave ``since``; nothing may read them any more."""
    gone, _paths[since:] = _paths[since:], []
    for path in gone:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session may be gone by then
        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, through Spark's file server."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="factloom-package-")) / f"{package.name}.zip"
    atexit.register(shutil.rmtree, archive.parent, True)
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, f"{package.name}/{file.relative_to(package)}")
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)
