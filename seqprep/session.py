"""Session settings and the shared folder for cut-lineage tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are tuned for. AQE coalesces small shuffle partitions
# and splits skewed join partitions; Arrow batches are bounded by bytes as well
# as rows, because one row can hold a very long text.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the recommended settings on a session of your own (all can change at run time)."""
    for name, value in RECOMMENDED.items():
        spark.conf.set(name, value)
    return spark


def group_by_group(spark: SparkSession) -> None:
    """From now on the session aggregates rows that already lie sorted by group one group after the other.

    Otherwise ``collect_list`` fills a hash table of up to 128 groups, whatever
    their size, then sorts the rows a second time, and spills both.
    """
    spark.conf.set("spark.sql.execution.replaceHashWithSortAgg", "true")


_LOCAL_DIRS: dict[str, str] = {}


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A single-JVM session with the recommended settings (tests, bench)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("seqprep")
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a single-JVM master may go without it: there the one machine is the
    cluster and a temporary folder does. Anywhere else it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="seqprep-")
    return _LOCAL_DIRS[app]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
_CLEANING: dict[object, list] = {}  # by session: how many writes go on, and the setting before them


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Queries run inside have their shuffle files removed as they end, not when the driver happens to collect its garbage."""
    session = spark._jsparkSession.hashCode()
    with _LOCK:
        going = _CLEANING.setdefault(session, [0, spark.conf.get(_CLEANUP, None)])
        going[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            going[0] -= 1
            if not going[0]:
                _CLEANING.pop(session)
                spark.conf.unset(_CLEANUP) if going[1] is None else spark.conf.set(_CLEANUP, going[1])


def write_shared(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the copy.

    Cuts the lineage without pinning blocks to executors: losing an executor
    afterwards costs a re-read, never a recomputation, and the shuffle files of
    its making are removed at once. The copies of an
    application lie in one folder, which ``remove_shared`` removes. ``codec``
    takes the place of the session's for Parquet.
    """
    path = f"{_own_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_copies(*frames: DataFrame, but: DataFrame | None = None) -> None:
    """Remove the written copies that ``frames`` read and ``but`` doesn't; the frames can't be read any more."""
    folders = [{path.rpartition("/")[0] for path in df.inputFiles()} for df in frames]
    still = {path.rpartition("/")[0] for path in but.inputFiles()} if but is not None else set()
    for folder in set().union(*folders) - still:
        spark = frames[0].sparkSession
        if folder.rpartition("/")[0].endswith(f"/seqprep-{spark.sparkContext.applicationId}"):
            remove_folder(spark, folder)


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/seqprep-{spark.sparkContext.applicationId}"


def remove_shared(spark: SparkSession) -> None:
    """Remove all copies this application has written; frames made from them can't be read any more."""
    remove_folder(spark, _own_folder(spark))


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder on any file system Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

