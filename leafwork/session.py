"""Session defaults and the few settings that operators read from the session."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(app: str = "leafwork", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A cluster names it in spark.checkpoint.dir. Only a local session without one gets a folder of its own, which is removed
    when the process ends: on a cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir")
    present = context._jsc.sc().getCheckpointDir()
    if present.isDefined():
        return present.get()
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        shared = tempfile.mkdtemp(prefix="leafwork-checkpoint-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    context.setCheckpointDir(shared)
    return shared


def cut(frame: DataFrame) -> DataFrame:
    """`frame` written to the shared checkpoint folder and read back: lineage ends here and survives lost executors."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows that a broadcast side may have at most; wider joins shuffle.
BROADCAST_ROWS = 500_000
#: Parts over which the rows of one key are spread in a salted join.
SALTS = 16


def bounded(small: DataFrame, large: DataFrame, on: list[str], spread: str | None = None, how: str = "inner") -> DataFrame:
    """`large` joined with `small`, which is broadcast if it has at most BROADCAST_ROWS rows; it is counted for this.

    Beyond that both are shuffled; with `spread`, a column of `large` whose values share out the rows of one key, the key
    is salted by its hash, so that a key with a third of all rows is no single task.
    """
    if small.count() <= BROADCAST_ROWS:
        return large.join(F.broadcast(small), on, how)
    if spread is None:
        return large.join(small, on, how)
    salted = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return large.withColumn("__salt", F.pmod(F.hash(spread), F.lit(SALTS))).join(salted, [*on, "__salt"], how).drop("__salt")


_HELD: dict[str, tuple[tuple, DataFrame]] = {}


def once(spark: SparkSession, name: str, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """build() written to the checkpoint folder, and read from there again while the session lasts and the files at
    `path` are the same. Of each name the last is kept; the one before is released for cleaning."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
    key = (spark.sparkContext.applicationId, path, status.getModificationTime(), status.getLen())
    held = _HELD.get(name)
    if held is None or held[0] != key:
        held = _HELD[name] = (key, cut(build()))
    return held[1]


def forget() -> None:
    """Lets go of what `once` holds, so that the next call builds it anew."""
    _HELD.clear()
