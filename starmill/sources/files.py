"""Delimited-file scans with a fixed schema and file lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

REJECTED = "_rejected_line"
SOURCE_FILE, INGESTED_AT, ARRIVED_AT = "_source_file", "_ingested_at", "_arrived_at"


def _layout(delimiter: str) -> dict:
    return {"header": True, "sep": delimiter}


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    delimiter: str = ",",
    rejects: bool = False,
    header: bool = True,
) -> DataFrame:
    """Read every file the path or glob names as one relation.

    Columns bind by position and the header line, if there is one, is skipped.  Nothing is inferred, so
    there is no extra pass; a field that does not fit its type becomes NULL and spaces
    are kept.  Uncompressed files split at ``spark.sql.files.maxPartitionBytes`` and
    small ones are packed together.

    ``rejects`` adds a column that holds the whole line where it does not fit the schema: fewer
    or more fields, or a field of another type.
    """
    reader = spark.read.options(**_layout(delimiter) | {"header": header})
    if rejects:
        schema = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", REJECTED)
    return reader.schema(schema).csv(path)


def stream_csv(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",", files_at_once: int | None = None
) -> DataFrame:
    """The same scan as a stream: each run reads the files that its checkpoint has not seen.

    ``files_at_once`` bounds a micro-batch.  Files must be complete when they appear under the
    path, and a file that changes under its old name is not read again.
    """
    bound = {} if files_at_once is None else {"maxFilesPerTrigger": files_at_once}
    return spark.readStream.schema(schema).options(**_layout(delimiter), **bound).csv(path)


def with_audit(df: DataFrame) -> DataFrame:
    """Add the file each row came from and the time of this run."""
    return df.withColumns({SOURCE_FILE: F.col("_metadata.file_path"), INGESTED_AT: F.current_timestamp()})


def with_arrival(df: DataFrame) -> DataFrame:
    """Audit columns, and when each row's file was last written: an order of batches that needs
    no naming convention."""
    return with_audit(df).withColumn(ARRIVED_AT, F.col("_metadata.file_modification_time"))
