"""File sources and sinks.

Readers take a declared schema (``inferSchema`` is an opt-in that costs an
extra pass over the data). Writers are distributed: one file per partition;
``single_file=True`` (``coalesce(1)``) is an explicit opt-in for small exports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
NULL_SENTINEL = "\u0000"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True,
             infer: bool = False, multiline: bool = False, escape: str | None = None,
             keep_rejects: bool = False, empty_is_null: bool = True,
             ignore_corrupt_files: bool = False) -> DataFrame:
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if ignore_corrupt_files:
        # an unreadable file is skipped (the reference skipped a failing source)
        r = r.option("ignoreCorruptFiles", True)
    if not empty_is_null:
        # a quoted "" stays an empty string; only a field with no content is null
        r = r.option("nullValue", NULL_SENTINEL)
    if multiline:
        r = r.option("multiLine", True)
    if escape is not None:
        r = r.option("escape", escape)
    if schema is not None:
        if keep_rejects:
            schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
            r = r.option("columnNameOfCorruptRecord", CORRUPT)
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_csv_strings(spark: SparkSession, path: str, casts: dict[str, str]) -> DataFrame:
    """Header-only read (every column a string), then ``try_cast`` per column."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[
        F.expr(f"try_cast(`{c}` AS {casts[c]})").alias(c) if c in casts else F.col(f"`{c}`")
        for c in raw.columns
    ])


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files under ``path``, empty ones too; their contents are not read."""
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # Spark's own listing knows every name, but a scan of it passes over files of no length.
    names = spark.createDataFrame([(name,) for name in there.inputFiles()], "path string")
    sizes = there.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"))
    plain = F.regexp_replace("path", "^file:/+", "file:///")  # the two lists write local paths in two ways
    return (names.withColumn("path", plain).join(sizes.withColumn("path", plain), "path", "left")
            .select("path", F.coalesce("length", F.lit(0)).alias("length")))


def skipped_files(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """(path): the files under ``path`` that hold something and gave ``rows`` (a read with ``ignore_corrupt_files``) no row."""
    read = rows.select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:///").alias("path")).distinct()
    return listed_files(spark, path).where("length > 0").select("path").join(read, "path", "left_anti")


def load_ledger(spark: SparkSession, path: str, schema: T.StructType, header: bool = False, source=None) -> DataFrame:
    """What became of each source: (source, outcome, reason, files, good_rows, rejected_rows).

    The files under ``path`` are read once, as lines (one record a line), and every line is parsed with
    ``schema``. ``source`` is a function of the file path's column (default: the file is the source). Outcomes:
    * ``loaded``: every record fits the schema; ``partial``: some; ``rejected``: none;
    * ``empty``: nothing but a header, or nothing at all, could be read and it was no fault;
    * ``unreadable``: files with content that gave no line. It comes before the others, as a file is lost.
    """
    source = source or (lambda c: c)
    lines = (spark.read.option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).text(path)
             .select("value", F.regexp_replace("_metadata.file_path", "^file:/+", "file:///").alias("path")))
    parsed = F.from_csv("value", T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]).simpleString()[7:-1].replace(":", " "),
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    title = F.trim("value") == ""  # like the CSV reader, a blank line is no record
    if header:
        title = title | (F.col("value") == F.lit(",".join(schema.names)))
    bad = parsed.getField(CORRUPT).isNotNull()
    per_file = lines.groupBy("path").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(~title & ~bad).alias("good"), F.count_if(~title & bad).alias("bad"))
    known = listed_files(spark, path).join(per_file, "path", "left")
    lost = F.col("lines").isNull() & (F.col("length") > 0)
    sums = known.groupBy(source(F.col("path")).alias("source")).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(lost).alias("lost"), F.coalesce(F.sum("good"), F.lit(0)).alias("good_rows"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("rejected_rows"))
    outcome = (F.when(F.col("lost") > 0, "unreadable").when(F.col("good_rows") + F.col("rejected_rows") == 0, "empty")
               .when(F.col("rejected_rows") == 0, "loaded").when(F.col("good_rows") > 0, "partial").otherwise("rejected"))
    reason = (F.when(F.col("lost") > 0, F.concat(F.col("lost").cast("string"), F.lit(" of "), F.col("files").cast("string"), F.lit(" files can't be read")))
              .when(F.col("good_rows") + F.col("rejected_rows") == 0, "no records")
              .when(F.col("rejected_rows") > 0, F.concat(F.col("rejected_rows").cast("string"), F.lit(" of "),
                    (F.col("good_rows") + F.col("rejected_rows")).cast("string"), F.lit(" records don't fit the schema"))))
    return sums.select("source", outcome.alias("outcome"), reason.alias("reason"), "files", "good_rows", "rejected_rows")


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
              single_file: bool = False, partition_by=None, order_by=None) -> None:
    """CSV export. ``order_by`` sorts globally at the sink (range-partitioned,
    part files in key order); ``mode="errorifexists"`` refuses to overwrite."""
    out = df
    if order_by:
        out = out.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    out = out.coalesce(1) if single_file else out
    w = (out.write.mode(mode).option("header", header).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.csv(path)


def rebalance(df: DataFrame, cols) -> DataFrame:
    """Cluster rows by the output partition columns before a partitioned write.

    The REBALANCE hint (not ``repartition``) lets AQE size the output
    partitions: values are clustered so each writes few files, and a skewed
    value (a day holding a large share of the rows) is split over several
    tasks instead of being written by one.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.hint("rebalance", *cols)


def write_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> None:
    if partition_by:
        df = rebalance(df, partition_by)
    w = df.write.mode(mode)
    if partition_by:
        # dynamic: only the partitions present in df are replaced
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(
            *([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.option("basePath", path)
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)
