"""History files taken up as they arrive.

The stream's checkpoint is the ledger of files already taken. Every micro-batch
holds whole files and is staged in a folder named after its number, which a
replayed batch overwrites, so rows are neither lost nor repeated. ``live_csv`` is a
sink of the same kind.

Spark's own ``clean_source`` removes files once taken, whether their rows were any good
or not. ``remove_taken`` removes those of batches that the checkpoint has committed and
whose rows are all sound and whole; the others stay to be looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palimpsest.operators.quality import quarantined_rows, sound_rows
from palimpsest.sinks.csv_files import write_parallel_csv
from palimpsest.sources.history import RECORD_END, stage_history, staged_history, with_source


def stream_history(
    spark: SparkSession,
    path: str,
    staging: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    glob: str | None = None,
    clean_source: str = "off",
    archive: str | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    max_file_age: str = "36500d",
    strict_elements: bool = False,
) -> StreamingQuery:
    """Stage the files under ``path`` that are new; stops when there are no more.

    ``on_batch`` receives the rows of each batch and its number, for a sink that
    is fed as files arrive; it is called again with the same number if the batch
    is replayed. ``clean_source`` (``delete``, or ``archive`` with a folder)
    removes files once taken, which Spark does while later batches run: the
    files of the last batch stay. Files are taken whatever their age: Spark would
    pass over those much older than the newest it has seen, which ``max_file_age``
    puts off by a century.
    """
    reader = spark.readStream.option("lineSep", RECORD_END).option(
        "maxFilesPerTrigger", files_per_batch
    )
    reader = reader.option("recursiveFileLookup", "true").option("cleanSource", clean_source)
    reader = reader.option("maxFileAge", max_file_age)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if archive is not None:
        reader = reader.option("sourceArchiveDir", archive)

    def take(records: DataFrame, number: int) -> None:
        stage_history(records, staging, mode="overwrite", part=f"batch={number}")
        if on_batch is not None:
            rows = staged_history(records.sparkSession, staging, strict_elements, f"batch={number}")
            on_batch(rows, number)

    records = with_source(reader.text(path))
    writer = records.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def streamed_history(spark: SparkSession, staging: str, strict_elements: bool = False) -> DataFrame:
    """Rows of all batches staged so far; ``unclosed_files`` tells which files end early."""
    return staged_history(spark, staging, strict_elements)


def live_csv(path: str, compression: str = "none") -> Callable[[DataFrame, int], None]:
    """For ``on_batch``: each batch's sound rows as CSV files with a header, in a folder of its own.

    A batch that is replayed replaces its folder. ``read_parallel_csv`` reads all batches;
    rows that are no revision stay in the staging folder (``quarantined_rows``).
    """

    def write(rows: DataFrame, number: int) -> None:
        write_parallel_csv(sound_rows(rows), f"{path}/batch={number}", compression=compression)

    return write


def committed_batches(spark: SparkSession, checkpoint: str) -> list[int]:
    """Numbers of the batches that a stream has finished."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path)]
    return sorted(int(name) for name in names if name.isdigit())


def proven_files(spark: SparkSession, staging: str, checkpoint: str, strict_elements: bool = False) -> DataFrame:
    """``file_path`` of the files of committed batches whose every revision is sound, and that end whole."""
    batches = committed_batches(spark, checkpoint)
    if not batches:
        return spark.createDataFrame([], "file_path string")
    rows = spark.read.parquet(f"{staging}/rows").where(F.col("batch") <= batches[-1])
    whole = rows.groupBy("file_path").agg(F.max("root_closed").alias("whole")).where("whole")
    bad = quarantined_rows(streamed_history(spark, staging, strict_elements)).select("file_path").distinct()
    return whole.select("file_path").join(bad, "file_path", "left_anti")


def remove_taken(
    spark: SparkSession, staging: str, checkpoint: str, archive: str | None = None, strict_elements: bool = False
) -> int:
    """Delete proven files, or move them below ``archive``; returns how many there were.

    Call it when the stream stands still or between its runs: a batch that has not been
    committed is read again from its files. Files already removed are passed over.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    count = 0
    for row in proven_files(spark, staging, checkpoint, strict_elements).toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.file_path))
        system = path.getFileSystem(conf)
        if not system.exists(path):
            continue
        if archive is None:
            done = system.delete(path, False)
        else:
            to = jvm.org.apache.hadoop.fs.Path(f"{archive.rstrip('/')}/{path.toUri().getPath().lstrip('/')}")
            system.mkdirs(to.getParent())
            done = system.rename(path, to)
        if not done:
            raise OSError(f"could not remove {row.file_path}")
        count += 1
    return count
