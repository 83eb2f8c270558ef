"""File and table sources/sinks: CSV ingest (S1), CSV/table writes (S3-S5),
document listing (S6) and row counts observed on the write itself (S7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shopmarts.session import shared_path

CORRUPT = "_corrupt_record"

# One dialect for reading and writing: quotes are doubled inside quotes, line
# breaks may stand inside quotes, nothing is trimmed, and only an unquoted empty
# field is null.
DIALECT = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"',
           "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# What the parser puts for an unquoted empty field, so that a quoted one can differ.
# A value of exactly these characters reads back as null.
NO_VALUE = "\x01\x02no value\x02\x01"
# A file with quoted line breaks is read by one task, so files stay this short.
ROWS_PER_FILE = 500_000


def read_csv(spark: SparkSession, path: str, schema: StructType, *,
             keep_corrupt: bool = False) -> DataFrame:
    """Header CSV, UTF-8, explicit schema (no inference).

    ``enforceSchema=false`` checks each file's header against the schema, so a
    reordered header raises instead of silently shifting position-bound columns.
    With ``keep_corrupt`` a malformed row keeps its raw text in ``_corrupt_record``
    (PERMISSIVE mode) so quality checks can report it.  Quoted line breaks are
    part of a value (``multiLine``): a file is read by one task, so large inputs
    should come as many files, as ``write_csv`` makes them.
    """
    if keep_corrupt:
        schema = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    r = (spark.read.format("csv")
         .options(**DIALECT, emptyValue="", nullValue=NO_VALUE)
         .option("multiLine", "true")
         .option("enforceSchema", "false")
         .option("mode", "PERMISSIVE")
         .schema(schema))
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    return r.load(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Distributed header CSV write, overwrite; values come back as they were
    (line breaks, quotes, backslashes, padding, empty against null)."""
    (df.write.mode("overwrite").options(**DIALECT, emptyValue='""', nullValue="")
     .option("maxRecordsPerFile", ROWS_PER_FILE).csv(path))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back, so that
    several readers share one computation and a lost executor costs a reread."""
    path = shared_path(df.sparkSession, "steps", label, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_counted(df: DataFrame, writer) -> int:
    """Run ``writer(observed_df)`` and return the row count seen by that same job."""
    obs = Observation()
    writer(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])


def save_table(df: DataFrame, name: str, *, path: str | None = None,
               fmt: str = "parquet", partition_by=None, bucket_by=None) -> int:
    """Full-overwrite table sink; the written schema replaces the old one.

    Returns the row count observed during the write (no second job).
    """
    def writer(d: DataFrame) -> None:
        if partition_by and not bucket_by:
            # group rows by partition value into right-sized files: AQE splits a
            # hot value (a huge month) and coalesces small ones, instead of every
            # input task writing one small file per value
            d = d.hint("rebalance", *partition_by)
        w = d.write.format(fmt).mode("overwrite")
        if path:
            w = w.option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if bucket_by:
            n, cols = bucket_by
            # one task per bucket, so one file per bucket
            w = d.repartition(n, *cols).write.format(fmt).mode("overwrite")
            w = w.option("path", path) if path else w
            w = w.bucketBy(n, *cols).sortBy(*cols)
        w.saveAsTable(name)

    return write_counted(df, writer)


def document_inventory(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """File listing (name, size) of a folder; the file contents are never read.

    ``binaryFile`` only loads ``content`` when it is selected, so this is a pure
    listing job distributed over the folder's files.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
            .select(F.element_at(F.split("path", "/"), -1).alias("name"),
                    F.col("length").alias("size")))


def require_documents(inventory: DataFrame, minimum: int = 10) -> DataFrame:
    """The inventory, after checking that at least ``minimum`` files are listed."""
    n = inventory.count()
    if n < minimum:
        raise ValueError(f"only {n} documents found, at least {minimum} required")
    return inventory
