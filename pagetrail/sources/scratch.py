"""Where jobs may put tables of their own."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
ROWS_PER_FILE = 500_000  # of a table whose size is known; rows of some numbers each
BYTES_PER_FILE = 32 << 20  # of texts
# On a local or mounted folder no file of checksums is written beside each file: one file less
# and one process (chmod) less to start. Parquet's own page checksums are verified instead.
WRITING = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
    "parquet.page.write-checksum.enabled": "true",
}
READING = {"parquet.page.verify-checksum.enabled": "true"}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder; on a
    cluster that would be a different folder on every machine, so it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError(f"set {SETTING} to a folder all machines share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pagetrail-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def text_files(texts: DataFrame, text: str = "text") -> int:
    """The tasks that a table of the given texts is to be written by: one for some tens
    of MB, and one for each core at least.

    It reads the lengths of all texts. ``coalesce`` takes the number; unlike the shuffle
    partitions or the splits of the files before, it does not leave a file for each of
    some hundreds of small parts.
    """
    size = texts.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
    return max(texts.sparkSession.sparkContext.defaultParallelism, -(-size // BYTES_PER_FILE))


def scratch_table(
    df: DataFrame, name: str, rows: int | None = None, per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Write ``df`` to a new scratch path and read it back, so it is computed once.

    ``rows`` is a bound for the number of rows, where one is known. The last stage then has
    as many tasks as files of ``per_file`` rows take, rather than one for every partition
    of the shuffle before it, which makes many tiny files of a small table. So give it
    with a ``per_file`` that is also a fair amount of work for a task. Tables of texts take
    ``coalesce`` with ``text_files`` instead, as these may be long.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // per_file)))
    path = scratch_path(df.sparkSession, name)
    df.write.options(**WRITING).parquet(path)
    return df.sparkSession.read.schema(df.schema).options(**READING).parquet(path)
