"""Session helpers: table access, durable intermediate results, checked broadcasts."""

from __future__ import annotations

import io
import pathlib
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side that is ever broadcast, in bytes of its JSON form.
BROADCAST_BYTES = 16 * 1024 * 1024
#: Session setting under which an action drops its shuffle files once it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Copies written so far inside each :func:`settled` that has begun and not ended.
_begun: list[list[DataFrame]] = []


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once for each Spark context.

    Its functions run in Python workers that import it; with ``--py-files`` or an
    installed package this changes nothing.
    """
    sc = spark.sparkContext
    if getattr(sc, "_lamella_shipped", False):
        return
    root = pathlib.Path(__file__).resolve().parent.parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(pathlib.PurePosixPath(root.name) / f.relative_to(root).as_posix()))
    # A driver-local file that Spark's own file server hands to every executor.
    archive = pathlib.Path(tempfile.mkdtemp(prefix="lamella-package-")) / "lamella_package.zip"
    archive.write_bytes(held.getvalue())
    sc.addPyFile(str(archive))
    sc._lamella_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder in ``spark.checkpoint.dir``; only a local master may fall back to a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not (sc.master or "").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="lamella-checkpoint-")
    sc.setCheckpointDir(shared)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the written copy.

    Cuts the lineage, so that a lost executor costs one read of the copy and not
    the work that led to it. A checkpoint keeps the estimated size of its plan, which for a join
    is the product of both sides: over the levels of a contraction the number alone outgrows the
    driver. So the copy is of unknown size to the planner, and nothing is broadcast before it was measured.
    Shuffle files that led to the copy go at once; else they stay until the driver happens to collect garbage.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        # The setting is read when a DataFrame is made, so this must be a new one.
        written = df.select("*").checkpoint(eager=True)._jdf
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    unsized = written.sparkSession().internalCreateDataFrame(written.queryExecution().toRdd(), written.schema(), False)
    copy = type(df)(unsized, spark)
    copy._lamella_file = written.queryExecution().logical().rdd().getCheckpointFile().get()
    if _begun:
        _begun[-1].append(copy)
    return copy


def release(*copies: DataFrame) -> None:
    """Delete copies of :func:`durable`; nothing that was made of them may be run any more."""
    for c in copies:
        path = c.sparkSession._jvm.org.apache.hadoop.fs.Path(c._lamella_file)
        path.getFileSystem(c.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """A durable copy of what ``make`` gives; all copies that were written on the way to it are deleted."""
    _begun.append([])
    try:
        copy = durable(make())
    finally:
        made = _begun.pop()
    release(*[c for c in made if c is not copy])
    if _begun:
        _begun[-1].append(copy)
    return copy


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows in JSON form; one aggregate over ``df``."""
    row = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))).alias("b")).first()
    return int(row["b"] or 0)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is within ``limit``, else ``df`` as it is.

    Without the hint Spark plans a shuffled join, which adaptive execution splits
    where a key is hot. Call it on a written or cheap side: measuring runs it once.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df
