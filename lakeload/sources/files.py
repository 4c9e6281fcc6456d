"""Landed files: scans, freshness, snapshot and append writes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from lakeload.functions.times import FRESHNESS_ZONE, zone_text
from lakeload.operators.conform import source_column


def read_landed(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, by_line: bool = False
) -> DataFrame:
    """Scan a landed file or directory; its extension (case-sensitive) picks the format.

    By default a JSON file is one document and CSV values may contain newlines,
    so a single task must read each file. ``by_line`` says that every record is
    one line, which lets files split. Giving ``schema`` spares CSV and JSON a
    pass over the data to infer it. Any file system Spark is configured for
    works.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    if path.endswith(".parquet"):
        return reader.parquet(path)
    if path.endswith(".csv"):
        # quotes inside values are doubled
        return reader.csv(path, header=True, inferSchema=schema is None, multiLine=not by_line, escape='"')
    if path.endswith(".json"):
        return reader.json(path, multiLine=not by_line)
    raise ValueError(f"unsupported file format: {path}")


def file_freshness(spark: SparkSession, path: str, zone: str = FRESHNESS_ZONE) -> DataFrame:
    """Per file under ``path``: last modification as local wall-clock text.

    Uses the binary-file source with only its metadata columns, so listing is
    all that happens; no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file_path"), zone_text(F.col("modificationTime"), zone).alias("modified_at"))


def scan_freshness(df: DataFrame, zone: str = FRESHNESS_ZONE) -> DataFrame:
    """The same for the files a scan reads, with the rows each holds."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file_path"))
    return per_file.agg(
        zone_text(F.max("_metadata.file_modification_time"), zone).alias("modified_at"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def last_modified(spark: SparkSession, path: str, zone: str = FRESHNESS_ZONE) -> str | None:
    """The newest modification under ``path`` as text, None if nothing is there."""
    try:
        return file_freshness(spark, path, zone).agg(F.max("modified_at")).first()[0]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def newest_modification(spark: SparkSession, path: str) -> datetime | None:
    """The newest modification under ``path`` as an instant in UTC, None if nothing is there. Lists files, opens none."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    micros = files.agg(F.unix_micros(F.max("modificationTime"))).first()[0]
    return None if micros is None else datetime(1970, 1, 1) + timedelta(microseconds=micros)


def read_newer(spark: SparkSession, path: str, schema: T.StructType, since: datetime | None, until: datetime | None = None) -> DataFrame:
    """Rows of the Parquet files under ``path`` modified after ``since`` and up to ``until`` (UTC instants).

    Files are left out when they are listed, by their modification time, so one
    that is not newer is never opened. Without ``since`` all files are read.
    """
    reader = spark.read.schema(schema).option("timeZone", "UTC")
    if since is not None:
        reader = reader.option("modifiedAfter", since.isoformat(timespec="microseconds"))
    if until is not None:  # files that land after the listing belong to the next load
        reader = reader.option("modifiedBefore", (until + timedelta(milliseconds=1)).isoformat(timespec="microseconds"))
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return no_rows(spark, schema)
        raise


def read_drifted(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files under ``path`` although columns came or went between them.

    The schema is the union of the files' columns, read from their footers in
    tasks; a column that a file lacks is NULL in its rows.
    """
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path)


def drift_by_file(df: DataFrame, declared: Sequence[str], file: Column | None = None) -> DataFrame:
    """Per file of a scan: declared columns it has no value in, and undeclared ones it has.

    (``file_name``, ``column_name``, ``drift``: ``empty`` or ``undeclared``,
    ``n_rows``, ``n_values``), from one aggregation by file. A merged scan shows
    NULL for a column that a file lacks, so an absent column and one without any
    value are the same here: neither has anything to load.
    """
    file = F.col("_metadata.file_name") if file is None else file
    lacking = [c for c in declared if c not in df.columns]
    counts = [F.count(source_column(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    per_file = df.groupBy(file.alias("file_name")).agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    names = {c: F.col(f"n{i}") for i, c in enumerate(df.columns)} | {c: F.lit(0).cast("long") for c in lacking}
    seen = [F.struct(F.lit(c).alias("column_name"), F.lit(c in declared).alias("known"), n.alias("n_values")) for c, n in names.items()]
    lines = per_file.select("file_name", "n_rows", F.explode(F.array(*seen)).alias("c")).select("file_name", "c.column_name", "c.known", "n_rows", "c.n_values")
    lines = lines.where("known = (n_values = 0)")
    return lines.select("file_name", "column_name", F.when(F.col("known"), "empty").otherwise("undeclared").alias("drift"), "n_rows", "n_values")


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace the file set at ``path``, straight at its final location."""
    df.write.mode("overwrite").parquet(path)


def bloom_filtered(writer: DataFrameWriter, column: str, keys: int) -> DataFrameWriter:
    """A Parquet writer whose files carry Bloom filters of a column, sized for ``keys`` distinct values each."""
    return writer.option(f"parquet.bloom.filter.enabled#{column}", True).option(f"parquet.bloom.filter.expected.ndv#{column}", keys)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 5) -> None:
    """Files that searches by any of ``columns`` can skip, by Z-order.

    Each column is cut into 2 ** ``bits`` ranges at its approximate quantiles
    (one pass, that many numbers for the driver), and rows are ranged by the
    interleaved range numbers, so a file covers a box of all columns instead of
    a thin slice of the first. Rows of one box are spread by their content, so a
    value of any weight is split over files; NULLs lie with the least values.
    Numbers and dates are skipped by statistics; Spark reads no statistics of
    zone-less timestamps, so cluster by their date or month instead.
    """
    ordered = {c: _ordinal(source_column(c), df.schema[c].dataType) for c in columns}
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*(F.percentile_approx(o, cuts, 10_000).alias(f"q{i}") for i, o in enumerate(ordered.values()))).first()
    curve = F.lit(0).cast("long")
    for i, o in enumerate(ordered.values()):
        bounds = sorted(set(found[f"q{i}"] or []))
        place = F.lit(0)
        for b in bounds:
            place = place + F.when(o > F.lit(b), 1).otherwise(0)
        for bit in range(bits):
            curve = curve.bitwiseOR(F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(ordered) + i))
    z, spread = "__z", "__spread"
    ranged = df.withColumn(z, curve).withColumn(spread, F.xxhash64(*map(source_column, df.columns)))
    ranged = ranged.repartitionByRange(files, z, spread).sortWithinPartitions(z, *map(source_column, columns)).drop(z, spread)
    ranged.write.mode("overwrite").parquet(path)


def _ordinal(col: Column, kind: T.DataType) -> Column:
    """A number that sorts like the column's values."""
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.to_timestamp_ltz(col) if isinstance(kind, T.TimestampNTZType) else col).cast("double")
    raise ValueError(f"no order by number for {kind.simpleString()}")


def append_parquet(df: DataFrame, path: str) -> None:
    """Add rows to the file set at ``path``, which must have the same columns and types.

    Existing files are not rewritten. A repeated append repeats its rows; a
    month table (:mod:`lakeload.tables`) absorbs repeats.
    """
    existing = existing_schema(df.sparkSession, path)
    if existing is not None:
        require_same_columns(df.schema, existing)
    df.write.mode("append").parquet(path)


def existing_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of the Parquet files at ``path``, None if there are none yet."""
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, base: str | None = None) -> DataFrame:
    """Parquet files of a known schema, no rows if the path does not exist yet; reads no footers.

    ``base`` is the table folder when ``path`` names some of its partitions.
    """
    reader = spark.read.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return no_rows(spark, schema)
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern matches anything; lists it, reads nothing."""
    try:
        spark.read.schema("x int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame, without going through Python data."""
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def require_same_columns(incoming: T.StructType, existing: T.StructType) -> None:
    got = [(f.name, f.dataType) for f in incoming]
    want = [(f.name, f.dataType) for f in existing]
    if got != want:
        raise ValueError(f"columns differ: incoming {incoming.simpleString()}, existing {existing.simpleString()}")


def union_all(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both inputs' rows; column names and types must agree."""
    if dict(first.dtypes) != dict(second.dtypes):
        raise ValueError(f"columns differ: {first.dtypes} and {second.dtypes}")
    return first.unionByName(second)
