"""Landing files picked up since the last run, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierhouse.sources.csv import READ_OPTIONS

BATCH = "batch"
SOURCE_FILE = "source_file"
BAD_LINE = "bad_line"


def landing_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    bad_lines: bool = False,
    archive: str | None = None,
) -> DataFrame:
    """Typed rows of CSV files as they arrive; a bad value fails the batch.

    With `bad_lines` it does not: the line is in a column of that name, which is
    NULL in good rows, and every row has the name of its file. Files that are
    done move to `archive`, if it is given.
    """
    options = dict(READ_OPTIONS)
    if bad_lines:
        schema = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    if files_per_batch:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    rows = spark.readStream.schema(schema).options(**options).csv(folder)
    return rows.select("*", F.col("_metadata.file_name").alias(SOURCE_FILE)) if bad_lines else rows


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    rejects: str | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Append all files not loaded before to parquet at `out`, then stop.

    The checkpoint remembers the files, and a repeated batch changes nothing;
    call it from any scheduler. Without `rejects` a bad value stops the stream.
    With it, good rows go to `out` and bad lines, with the name of their file,
    to `rejects`; both have a folder for each batch.
    """
    rows = landing_stream(spark, folder, schema, files_per_batch, rejects is not None, archive)

    def split(batch: DataFrame, batch_id: int) -> None:
        bad = F.col(BAD_LINE).isNotNull()
        batch.persist()  # parsed once for both; it also makes a query of the bad lines alone possible
        try:
            for chosen, path in ((batch.where(~bad).drop(BAD_LINE), out), (batch.where(bad).select(BAD_LINE, SOURCE_FILE), rejects)):
                chosen.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        finally:
            batch.unpersist()

    if rejects is None:
        writer = rows.writeStream.format("parquet").option("path", out)
    else:
        writer = rows.writeStream.foreachBatch(split)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
