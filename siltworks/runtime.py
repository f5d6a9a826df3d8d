"""Session, table access and lineage cutting.

Iterative operators cut their lineage by writing a stage as parquet into the
shared folder that the cluster names in ``spark.checkpoint.dir``. Parquet is
used instead of RDD checkpoints because a stage that is read again keeps column
pruning and compression, and because it survives the loss of any executor.

Catalyst decides on a broadcast by the written size of a stage, which compression
can make a hundredth of what the rows take in memory. Operators whose stages hold
texts or arrays therefore measure the rows and forbid the broadcast of what is large
(``unless_large``).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "siltworks", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session with the settings that tests and the benchmark use."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SILT_DRIVER_MEMORY", "8g"))
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, columns: Iterable[str] | None = None) -> DataFrame:
    """One parquet table; with ``columns`` only those reach the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where none is set."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    jsc = spark.sparkContext._jsc.sc()
    at = jsc.getCheckpointDir()
    if at.isDefined():
        return str(at.get()).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="silt-")
    spark.sparkContext.setCheckpointDir(own)
    return str(jsc.getCheckpointDir().get()).rstrip("/")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a context, for Python workers."""
    sc = spark.sparkContext
    if getattr(sc, "_silt_shipped", False):
        return
    root = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp(prefix="silt-code-")) / "siltworks_code.zip"
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*")):
            if f.is_file() and f.suffix != ".pyc":
                z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(at))
    sc._silt_shipped = True


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the context may be gone already; the folder then stays
        pass


class Stages:
    """Written intermediate tables of one operator call.

    ``put`` writes a DataFrame and returns a reader of what was written;
    ``drop`` removes a stage that no later one reads. What is left is removed
    when the program ends, as a lazily returned result may still read it.
    """

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
        self.n = 0
        atexit.register(_delete, spark, self.root)

    def put(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._silt_path = path
        return out

    def drop(self, df: DataFrame | None) -> None:
        path = getattr(df, "_silt_path", None)
        if path:
            _delete(self.spark, path)


#: Nothing whose rows take more than this, measured and not as written, is left to
#: Catalyst to broadcast.
BROADCAST_BYTES = 8 << 20


def unless_large(df: DataFrame, size: float) -> DataFrame:
    """``df``, of which it is known how many bytes its rows take, as a side of a join: large ones are only joined by sort-merge."""
    return df.hint("merge") if size > BROADCAST_BYTES else df


#: Below this many rows a key is never hot: one task handles it in a second.
HOT_LEAST = 20_000


def hot_keys(df: DataFrame, *keys: str, least: int = HOT_LEAST) -> dict[int, int]:
    """Hashes of the keys that alone fill a task, each with the number of its salts.

    A key is hot when it holds more rows than the average task of a shuffle; its salts
    are as many as the tasks that it would fill, rounded up to a power of two. There are
    at most as many hot keys as shuffle partitions, whatever the data, so their list may
    be collected and broadcast. Counts are exact: every task counts its own rows first,
    only the partial counts are shuffled. A hash collision merely treats one key more
    as hot, which changes no result.
    """
    width = shuffle_width(df.sparkSession)
    counted = df.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    rows = counted.orderBy(F.desc("n"), "h").limit(width).collect()
    if not rows:
        return {}
    task = max(least, df.count() / width)
    return {r.h: 1 << (-int(-r.n // task)).bit_length() for r in rows if r.n >= task}


def is_hot(hot: dict[int, int], *keys) -> F.Column:
    return F.xxhash64(*keys).isin(list(hot)) if hot else F.lit(False)


def salts_of(hot: dict[int, int], *keys) -> F.Column:
    """The number of a key's salts: 1 unless it is hot."""
    out = F.lit(1)
    for n in sorted(set(hot.values())):
        out = F.when(F.xxhash64(*keys).isin([h for h, m in hot.items() if m == n]), F.lit(n)).otherwise(out)
    return out


def spread(df: DataFrame) -> DataFrame:
    """``df`` on all cores, where it is a scan of fewer partitions than there are cores.

    One small file is one task, however much work each of its rows makes. Inputs that
    already fill the cores, as all large ones do, and inputs that are shuffled anyway
    are left alone.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def time_limited(f, seconds: float):
    """``f`` for one row, giving None once it takes longer: for Python workers only."""
    import signal

    class TooLong(Exception):
        pass

    def late(*_):
        raise TooLong

    def run(*args):
        old = signal.signal(signal.SIGALRM, late)
        signal.setitimer(signal.ITIMER_REAL, seconds)
        try:
            return f(*args)
        except TooLong:
            return None
        finally:
            signal.setitimer(signal.ITIMER_REAL, 0)
            signal.signal(signal.SIGALRM, old)

    return run
