"""Shared plumbing: inputs, folds, and tables that outlive executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

import loomgraph
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_shipped: set[str] = set()
_made: dict[str, list[str]] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Give executors this package, once for each Spark application; keep Arrow batches small, as texts can be long."""
    sc = spark.sparkContext
    for key, value in (("maxRecordsPerBatch", "2000"), ("maxBytesPerBatch", str(8 << 20))):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", None) is None:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", value)
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(loomgraph.__file__)
    target = os.path.join(tempfile.mkdtemp(prefix="loomgraph-"), "loomgraph.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("loomgraph", os.path.relpath(path, root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one in local mode."""
    sc = spark.sparkContext
    set_to = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if set_to:
        return set_to.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="loomgraph-shared-")
    sc.setCheckpointDir(f"file://{own}")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    return sc.getCheckpointDir().rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    app = spark.sparkContext.applicationId
    if app not in _made:
        _made[app] = []
        atexit.register(_forget, spark, app)
    _made[app].append(path)
    return path


def _forget(spark: SparkSession, app: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        for path in _made.pop(app, []):
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may already have ended
        pass


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that no returned DataFrame reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def tidy(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a finished query only once the driver has collected its plan as garbage."""
    spark.sparkContext._jvm.System.gc()


def table(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: lineage ends here, and lost executors cost nothing.
    The write's shuffle files go as it ends; otherwise Spark keeps those of the last query even through a collection of garbage."""
    spark = df.sparkSession
    path, before = new_dir(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(k)


def held_out(doc_id: Column, k: int, r: int) -> Column:
    return F.coalesce(fold(doc_id, k) == r, F.lit(False))


def empty_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(docs: DataFrame) -> DataFrame:
    """row: each row of docs as one struct, so that columns added beside it cannot clash with the user's."""
    return docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"))
