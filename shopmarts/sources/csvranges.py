"""CSV with line breaks inside quotes, read by byte ranges (S1).

``read_csv`` gives a file to one task, because a line break may stand inside
quotes and a task that begins in the middle of a file can't tell.  Here a file is
read as physical lines over as many ranges as Spark makes of it.  A line break
ends a record where the quotes before it, counted from the file's start, are even:
each range's parity is one small row, a running sum over a file's ranges gives
every range its state at the start, and only lines of ranges that hold an open
quote are ordered and put together.  Each record then goes to ``from_csv``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shopmarts.sources.files import CORRUPT, DIALECT, NO_VALUE, read_csv, written

RANGE = ["file", "range"]
#: Quoted fields as they should be; a quote that is left is inside an unquoted field.
QUOTED = r'(?:^|(?<=,))"[^"]*+(?:""[^"]*+)*+"(?=,|$)'


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, range, pos, line, odd``: every line, where its byte range starts, its
    order in the range, and whether it has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("range"),
                    F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"),
                    (quotes % 2 == 1).alias("odd")))


def range_states(lines: DataFrame) -> DataFrame:
    """``file, range, inside, plain, first``: whether a range starts inside quotes,
    whether all its lines are records of their own, and its first line's place.

    One row a range: the running sum over a file's ranges is the only thing that is
    done in the file's order."""
    ranges = lines.groupBy(*RANGE).agg(F.count_if("odd").alias("odds"), F.min("pos").alias("first"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odds").over(before), F.lit(0)) % 2 == 1
    return ranges.select(*RANGE, inside.alias("inside"),
                         (~inside & (F.col("odds") == 0)).alias("plain"), "first",
                         F.col("odds").alias("odds"))


def records(lines: DataFrame, states: DataFrame) -> DataFrame:
    """``file, head, record``: every record's text, and whether it is its file's first.

    Lines of plain ranges are records and stay where they were read.  In the other
    ranges a window over the range's lines finds the record starts; lines of
    records that take several are grouped by the place of their first line, which
    for the lines at a range's start lies in an earlier range."""
    # both tables that lines are joined with are short: one row for each range with an
    # open quote, and one a file
    broken = states.filter(~F.col("plain"))
    firsts = states.filter("range = 0").select("file", F.col("first").alias("pos"),
                                               F.lit(True).alias("is_first"))
    head = F.coalesce("is_first", F.lit(False))
    whole = (lines.join(broken.select(*RANGE), RANGE, "left_anti").join(firsts, ["file", "pos"], "left")
             .select("file", head.alias("head"), F.col("line").alias("record")))
    if broken.isEmpty():
        return whole
    known = lines.join(broken, RANGE).join(firsts, ["file", "pos"], "left")
    order = Window.partitionBy(*RANGE).orderBy("pos")
    flips = F.sum(F.col("odd").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = known.withColumn(
        "start", (F.coalesce(flips, F.lit(0)) + F.col("inside").cast("int")) % 2 == 0)
    opened = opened.withColumn("at", F.max(F.when(F.col("start"), F.col("pos"))).over(order))
    single = opened.filter(F.col("start") & ~F.col("odd")).select(
        "file", head.alias("head"), F.col("line").alias("record"))
    parts = opened.filter(~F.col("start") | F.col("odd")).select(
        *RANGE, "pos", "line", "at", head.alias("head"))
    # the last record start of each range, carried over the ranges that have none
    last = (opened.groupBy(*RANGE).agg(F.max("at").alias("last")))
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*RANGE, F.last(F.when(
        F.col("last").isNotNull(), F.struct(F.col("range").alias("from"), "last")),
        ignorenulls=True).over(earlier).alias("carried"))
    parts = parts.join(carried, RANGE).withColumn(
        "key", F.when(F.col("at").isNotNull(), F.struct(F.col("range").alias("from"), F.col("at").alias("last")))
        .otherwise(F.col("carried")))
    glued = parts.groupBy("file", "key").agg(
        F.array_sort(F.collect_list(F.struct("range", "pos", "line"))).alias("all"),
        F.max("head").alias("head"))
    glued = glued.select("file", "head", F.array_join(F.transform("all", lambda x: x["line"]), "\n")
                         .alias("record"))
    return whole.unionByName(single).unionByName(glued)


def _trimmed(record: Column) -> Column:
    """A record without its line end's carriage return; line ends inside as one."""
    return F.replace(F.regexp_replace(record, "\r$", ""), F.lit("\r\n"), F.lit("\n"))


def read_csv_ranges(spark: SparkSession, path: str, schema: StructType, *,
                    keep_corrupt: bool = False) -> DataFrame:
    """The rows of ``read_csv``, each file read by as many tasks as it has ranges.

    Records end with ``\\n`` or ``\\r\\n``; every file's first record must name the
    schema's columns in order, else this raises.  Counting quotes needs files in
    which quotes stand around whole fields only; files with a quote anywhere else
    (``5" pipe``) are found by a check of all records and read by ``read_csv``.
    """
    lines = physical_lines(spark, path)
    states = written(range_states(lines), "csv_ranges")
    rows = records(lines, states).withColumn("record", _trimmed(F.col("record")))
    rest = F.regexp_replace("record", QUOTED, "")
    stray = written(rows.filter(F.contains(rest, F.lit('"'))).select("file").distinct(), "csv_stray")
    odd = states.groupBy("file").agg((F.sum("odds") % 2 == 1).alias("open")).filter("open").select("file")
    slow = written(stray.unionByName(odd).distinct(), "csv_by_file")
    by_file = [r["file"] for r in slow.collect()]        # one name a file
    if by_file:
        rows = rows.join(slow, "file", "left_anti")
    names = F.transform(F.split("record", ","), lambda c: F.trim(F.regexp_replace(c, '^"|"$', "")))
    wrong = rows.filter(F.col("head") & (names != F.array(*(F.lit(f.name) for f in schema.fields))))
    bad = wrong.select("file", "record").head(1)
    if bad:
        raise ValueError(f"the header of {bad[0]['file']} is not the schema's: {bad[0]['record']}")
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType())])
    options = {**DIALECT, "emptyValue": "", "nullValue": NO_VALUE, "mode": "PERMISSIVE", "header": "false",
               "columnNameOfCorruptRecord": CORRUPT, "maxCharsPerColumn": "-1"}
    used = full if keep_corrupt else schema
    parsed = rows.filter(~F.col("head") & (F.col("record") != "")).select(
        F.from_csv("record", used.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    parsed = parsed.select(*(F.col("r").getField(f.name).alias(f.name) for f in used.fields))
    if by_file:
        parsed = parsed.unionByName(read_csv(spark, by_file, schema, keep_corrupt=keep_corrupt))
    return parsed
