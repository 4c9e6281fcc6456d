"""A catalog table bucketed by its record key, so that changes meet it without shuffling it.

The table's rows lie in a fixed number of buckets by the hash of the key, one
sorted file each. A change batch is brought into the same buckets, and every
join with the table then reads bucket beside bucket: of the two sides only the
batch is shuffled, however large the table is.

Two catalog tables take turns: a change writes the one not in use and then
points a view of the table's name at it, so readers see the old rows or the new
ones. A table has one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeload.operators.conform import source_column
from lakeload.operators.versioned import classify_changes, latest_version
from lakeload.sources.files import require_same_columns

_OLD, _NEW = "__old", "__new"


class BucketedTable:
    """One row per ``key``; ``modified`` decides which of two versions is newer.

    ``path`` is the folder its files lie in, ``buckets`` the number of files a
    version has: choose it once such that a bucket fits a task.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, key: str, modified: str, buckets: int) -> None:
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        self.key, self.modified, self.buckets = key, modified, buckets

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def replace(self, rows: DataFrame) -> None:
        """Make ``rows``, which have at most one per key, the table's content."""
        self._write(rows.repartition(self.buckets, self.key))

    def changes(self, batch: DataFrame) -> DataFrame:
        """``batch`` with column ``change``; the table is not shuffled for it."""
        return classify_changes(self._dealt(batch), self.read(), self.key, self.modified, unique=True)

    def upserted(self, batch: DataFrame) -> DataFrame:
        """The table's rows with new keys added and records replaced that ``batch`` modified strictly later.

        Of several batch rows per key the latest counts; each task keeps one per
        key before they are shuffled. Rows of the table without a key match nothing
        and stay; of a batch's rows without one, one is added.
        """
        table = self.read()
        require_same_columns(batch.schema, table.schema)
        newest = latest_version(batch, [self.key], [self.modified])
        old = table.select(source_column(self.key).alias("__k"), F.struct(*map(source_column, table.columns)).alias(_OLD))
        new = self._dealt(newest).select(source_column(self.key).alias("__n"), F.struct(*map(source_column, table.columns)).alias(_NEW))
        both = old.join(new, F.col("__k") == F.col("__n"), "full_outer")
        was, now = F.col(_OLD).getField(self.modified), F.col(_NEW).getField(self.modified)
        newer = F.col(_OLD).isNull() | (now.isNotNull() & (was.isNull() | (now > was)))
        kept = F.when(newer, F.col(_NEW)).otherwise(F.col(_OLD))
        return both.select(kept.alias("__row")).select(*(F.col("__row").getField(c).alias(c) for c in table.columns))

    def upsert(self, batch: DataFrame) -> None:
        """Store :meth:`upserted`; rows come out in the buckets they are written to."""
        self._write(self.upserted(batch))

    def _dealt(self, batch: DataFrame) -> DataFrame:
        return batch.repartition(self.buckets, source_column(self.key))

    def _write(self, rows: DataFrame) -> None:
        """Write the slot not in use, then show it."""
        slot = 1 - self._slot()
        writer = rows.write.format("parquet").mode("overwrite").option("path", f"{self.path}/slot{slot}")
        writer.bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(f"{self.name}_slot{slot}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM {self.name}_slot{slot}")

    def _slot(self) -> int:
        """Which of the two tables the view shows; 1 if there is none yet, so the first write takes 0."""
        if not self.spark.catalog.tableExists(self.name):
            return 1
        text = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'View Text'").first()
        return int(text["data_type"].rstrip()[-1])
