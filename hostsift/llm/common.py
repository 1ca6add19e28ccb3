"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space in the sense of every contract here: space and the bytes 09 to 0D.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the session's ``spark.checkpoint.dir``, or the folder that the application set by
    ``setCheckpointDir``.  Where both are unset (local tests) a folder of this process is
    made, set and removed at exit.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="hostsift-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base


#: Spark's switch to delete a query's shuffle files when the query ends, not when the driver collects its garbage.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables of one run in the shared folder; they cut lineage and outlive lost executors.

    An operator's result reads them, so they stay until ``close``, ``release`` or the interpreter's end.
    """

    opened: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        Scratch.opened.append(self)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read again.  Nothing needs the write's shuffle files once it has ended, so they go with it."""
        before = self.spark.conf.get(SHUFFLES_END, None)
        self.spark.conf.set(SHUFFLES_END, "true")
        try:
            df.write.parquet(self.path(name))
        finally:
            if before is None:
                self.spark.conf.unset(SHUFFLES_END)
            else:
                self.spark.conf.set(SHUFFLES_END, before)
        return self.load(name, df)

    def load(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.path(name))

    def close(self) -> None:
        if self in Scratch.opened:
            Scratch.opened.remove(self)
        try:
            self._delete(self.base)
        except Exception:  # noqa: BLE001  the session may have ended before the interpreter
            pass

    def _delete(self, path: str) -> None:
        sc = self.spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def release(but: tuple[Scratch, ...] = ()) -> None:
    """Deletes the intermediate tables of all results made so far, but for those named; a caller's results must be written by then."""
    for scratch in [s for s in Scratch.opened if s not in but]:
        scratch.close()


atexit.register(release)


def tidy(spark: SparkSession) -> None:
    """The driver collects its garbage: Spark drops what it broadcast for plans that are done, and the heap shrinks to what is used.

    For operators of many short jobs, whose plans and broadcasts pile up in the driver.
    """
    spark.sparkContext._jvm.java.lang.System.gc()


class RecentCache(dict):
    """key -> value by subclasses' ``make``, in two generations of bounded size.

    When the young generation is full it becomes the old one, so values that keep being
    used survive; keys of over 64 characters are never kept.
    """

    limit = 200_000

    def __init__(self):
        super().__init__()
        self.old: dict = {}

    def make(self, key):
        raise NotImplementedError

    def forget(self) -> None:
        """Called at the end of a task: an idle worker must not hold memory that a later stage needs."""
        self.old = {}
        self.clear()

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def squeezed(text: Column) -> Column:
    """Null as empty, and each run of white space as one space.

    The pattern matches only runs that change, so a text of single spaces costs
    one scan and no replacement.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"[\x09-\x0D]{SPACE}*|\x20{SPACE}+", " ")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for rows that training never sees: crc32 of the id as text, modulo folds, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def joined_by_size(rows: DataFrame, keyed: DataFrame, on: list[str], size: str, how: str = "inner", least: int = 1000, most: int = 4096) -> DataFrame:
    """``rows`` joined with ``keyed``, which has one row a key and in ``size`` the number of rows that hold it.

    Keys that hold more than ``least`` rows and more than one in ``most`` of all are fewer
    than ``most``, so these are broadcast and their rows stay where they are; all other
    rows are shuffled, and no task gets many of one key.  ``rows`` is read twice.
    """
    total, largest = keyed.agg(F.sum(size), F.max(size)).first()
    bar = max(least, (total or 0) // most)
    if (largest or 0) <= bar:
        return rows.join(keyed, on, how)
    hot, cold = keyed.filter(F.col(size) > bar), keyed.filter(F.col(size) <= bar)
    return rows.join(F.broadcast(hot), on).unionByName(rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on, how))
