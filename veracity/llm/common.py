"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.session import ensure_checkpoint_dir

#: One run of the white space that separates words (space, tab, LF, VT, FF, CR).
SPACE = r"[ \t-\r]+"
#: One word: a run of anything else.
WORD = r"[^ \t-\r]+"
SPACE_CODES = (9, 10, 11, 12, 13, 32)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_count(text: Column) -> Column:
    """Number of words without keeping them."""
    t = F.coalesce(text, F.lit(""))
    at_start = F.ascii(t).isin(*SPACE_CODES).cast("int")
    at_end = F.ascii(F.right(t, F.lit(1))).isin(*SPACE_CODES).cast("int")
    return F.when(t == "", 0).otherwise(F.size(F.split(t, SPACE)) - at_start - at_end).cast("long")


#: Spark's switch for shuffle files to go when the execution that wrote them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in ``spark.checkpoint.dir``.

    Nothing reads the shuffle files behind a written checkpoint, so they go at once instead of
    at the driver's next garbage collection; the session's setting is put back.
    """
    conf = df.sparkSession.conf
    ensure_checkpoint_dir(df.sparkSession)
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint()  # the setting is read where a plan is built
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark keeps it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def free(*frames: DataFrame) -> None:
    """Delete the files of checkpoints that nothing reads any more, now and not at the driver's next garbage collection."""
    for df in frames:
        file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            delete(df.sparkSession, file.get())
