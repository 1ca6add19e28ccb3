"""One CSV file of sorted rows, byte for byte as Python's csv writer makes it, written or appended in two phases.

Tasks write the sorted lines as parts with Spark's own commit, so a failed task or job
leaves the file alone.  Then the parts are joined behind the old bytes in a new file, which
takes the old one's place by one rename.  Where the store can join files without reading
them (``FileSystem.concat``) nothing passes through the driver; elsewhere the bytes are
streamed in a small buffer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import delete
from .sinks import _fs


def csv_field(c: Column) -> Column:
    """A field in quotes only where it must be; null as empty."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(text.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def csv_line(columns: list[str]) -> Column:
    fields = [csv_field(F.col(c)) for c in columns]
    # A line of one empty field would be read as no line.
    return F.when(fields[0] == "", '""').otherwise(fields[0]) if len(fields) == 1 else F.concat_ws(",", *fields)


def _join(spark: SparkSession, target: str, head: str | None, parts: list) -> None:
    """Makes ``target`` of the bytes of the file ``head``, if any, and then the parts."""
    sc = spark.sparkContext
    hadoop, conf = sc._jvm.org.apache.hadoop, sc._jsc.hadoopConfiguration()
    fs, path = _fs(spark, target)
    if head is not None and fs.getScheme() == "hdfs":
        fs.rename(hadoop.fs.Path(head), path)
        group = sc._gateway.new_array(hadoop.fs.Path, len(parts))
        for k, part in enumerate(parts):
            group[k] = part
        fs.concat(path, group)
        return
    out = fs.create(path, True)
    try:
        for part in ([hadoop.fs.Path(head)] if head else []) + parts:
            stream = fs.open(part)
            try:
                hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
            finally:
                stream.close()
    finally:
        out.close()


def write_csv_file(rows: DataFrame, path: str, order: list[Column | str], append: bool = False) -> int:
    """Writes or appends sorted rows and returns how many; a header comes first where the file is new or empty.

    Without rows nothing is written, and without ``append`` an old file goes.
    """
    spark = rows.sparkSession
    fs, target = _fs(spark, path)
    work = f"{path}.{uuid.uuid4().hex}"
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    try:
        rows.orderBy(*order).select(csv_line(rows.columns).alias("value")).write.option("lineSep", "\r\n").text(f"{work}/parts")
        parts = sorted((s.getPath() for s in fs.listStatus(hadoop.Path(f"{work}/parts")) if s.getPath().getName().startswith("part-") and s.getLen()), key=lambda p: p.getName())
        count = spark.read.option("lineSep", "\r\n").text(f"{work}/parts").count() if parts else 0
        if not parts:
            if not append:
                delete(spark, path)
            return 0
        old = append and fs.exists(target) and fs.getFileStatus(target).getLen() > 0
        head = f"{work}/head"
        if old:
            _join(spark, head, None, [target])
        else:
            stream = fs.create(hadoop.Path(head), True)
            try:
                stream.write(bytearray((",".join(rows.columns) + "\r\n").encode()))
            finally:
                stream.close()
        _join(spark, f"{work}/whole", head, parts)
        how = sc._gateway.new_array(hadoop.Options.Rename, 1)
        how[0] = hadoop.Options.Rename.OVERWRITE
        source, target = fs.makeQualified(hadoop.Path(f"{work}/whole")), fs.makeQualified(target)
        hadoop.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration()).rename(source, target, how)
        return count
    finally:
        delete(spark, work)
