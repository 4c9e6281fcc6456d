"""A stored table that keeps the newest version of each record, partitioned by month.

Plain Parquet files know no update or delete, so every change reads the months
it touches, transforms them and replaces them. Months that already have files
are first rewritten in a staging folder with a note of what they replace: the
table is only touched once its replacement is complete on disk. If the driver
dies in between, the next change, of whatever kind and from whatever session,
finds the note and finishes (or undoes) the interrupted one first; until then
the table refuses to be read. Note and staged rows lie in the table's own
folder, under a name that scans skip. A table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession, functions as F, types as T

from lakeload.contracts import TableContract
from lakeload.functions.times import UNDATED_MONTH, month_bucket, month_number, ntz, to_second
from lakeload.operators.incremental import date_between
from lakeload.operators.versioned import (
    MONTH,
    condition,
    delete_where,
    latest_by_contract,
    mark_synced,
    months_between,
    retained,
    upsert,
    with_month,
)
from lakeload.sources.files import bloom_filtered, no_rows, path_exists, read_or_empty, require_same_columns

_PARALLEL_WRITES = 8
_MONTHS = T.StructType([T.StructField(MONTH, T.IntegerType())])
_NOTE = T.StructType(
    [
        T.StructField("action", T.StringType()),
        T.StructField(MONTH, T.IntegerType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


class MonthTable:
    """One stored table.

    ``months_at_once`` bounds how many months a compaction, delete or mark
    rewrites, hence stages, in one go; each portion is complete in itself, so
    an interrupted change is continued by repeating it.

    With ``bloom_keys``, the distinct keys expected in a file, every file carries
    Bloom filters of the primary key: a search for a key then skips files whose
    key range holds it but whose rows do not.
    """

    def __init__(
        self, spark: SparkSession, path: str, contract: TableContract, months_at_once: int | None = None, bloom_keys: int | None = None
    ) -> None:
        if contract.date_column is None:
            raise ValueError(f"{contract.name}: a month table needs a date column")
        self.spark = spark
        self.path = path.rstrip("/")
        self.contract = contract
        self.months_at_once = months_at_once
        self.bloom_keys = bloom_keys
        plain = [T.StructField(f.name, f.dataType, True) for f in contract.schema]
        self.schema = T.StructType(plain)
        self._stored = T.StructType([*plain, T.StructField(MONTH, T.IntegerType(), True)])
        self._staging, self._note = f"{self.path}/_lakeload/rows", f"{self.path}/_lakeload/note"
        self._uncompacted = f"{self.path}/_lakeload/uncompacted"

    def read(self, months: Iterable[int] | None = None) -> DataFrame:
        """Rows with their month column, optionally of some months only.

        Naming the months' folders spares listing the files of all others,
        which a filter on the month column would not. While a change is pending
        that a dead driver left half done, reading is refused.
        """
        if self._pending():
            raise RuntimeError(f"{self.path}: a change was interrupted; recover() finishes it")
        return self._read(months)

    def _read(self, months: Iterable[int] | None = None) -> DataFrame:
        if months is None:
            return read_or_empty(self.spark, self.path, self._stored)
        months = set(months)
        if not months:
            return no_rows(self.spark, self._stored)
        return read_or_empty(self.spark, self._folders(months), self._stored, base=self.path)

    def _folders(self, months: set[int]) -> str:
        return f"{self.path}/{MONTH}={{{','.join(str(m) for m in sorted(months))}}}"

    def _has_files(self, months: set[int]) -> bool:
        return path_exists(self.spark, self._folders(months))

    def current(self) -> DataFrame:
        """The newest version of each record, whether or not the table is compacted."""
        return latest_by_contract(self.read(), self.contract).select(*self.schema.names)

    def between(self, first: date, last: date) -> DataFrame:
        """Rows whose table date lies in a day range; other months are not read."""
        return date_between(self.read(months_between(first, last)), self.contract.date_column, first, last)

    def months(self, where: Column | None = None) -> list[int]:
        """Months holding rows (that satisfy ``where``): a handful of numbers."""
        rows = self.read() if where is None else self.read().where(where)
        return sorted(r[0] for r in rows.select(MONTH).distinct().collect())

    def watermarks(
        self, known: tuple[datetime | None, datetime | None] = (None, None)
    ) -> tuple[datetime | None, datetime | None]:
        """(last sync mark, last modification) in one narrow scan; None where unset.

        ``known`` are values believed to occur in the table, such as those of
        the last audited run. Only rows at least that late are looked at first,
        which lets file statistics skip nearly everything; if there are none
        after all, the whole columns are read.
        """
        names = [self.contract.synced_column, self.contract.modified_column]
        picks = [F.max(c) if c else F.lit(None).cast("timestamp_ntz") for c in names]
        picks = [p.alias(f"w{i}") for i, p in enumerate(picks)]
        bounds = [F.col(c) >= ntz(at) for c, at in zip(names, known) if c and at]
        if bounds and len(bounds) == sum(c is not None for c in names):
            late = self.read().where(reduce(or_, bounds)).agg(*picks).first()
            if all(late[i] and late[i] >= at for i, (c, at) in enumerate(zip(names, known)) if c):
                return late["w0"], late["w1"]
        row = self.read().agg(*picks).first()
        return row["w0"], row["w1"]

    def append(self, df: DataFrame, whole: bool = False, months: Iterable[int] | None = None) -> None:
        """Add conformed rows as they are; older versions stay until compaction.

        Costs a write of the batch alone. Until :meth:`compact` has run, read
        the table with :meth:`current`. If the driver dies, part of the rows
        may have been added, unless ``whole``: then the next change adds all of
        them, which rows carrying a sync mark need. Rows added twice are
        versions of one record. The months touched, ``months`` if already known,
        are noted for the compaction.
        """
        require_same_columns(df.schema, self.schema)
        self.recover()
        rows = self._shaped(with_month(df, self.contract.date_column))
        seen = None
        if months is None:  # observed on the way
            seen = Observation("months")
            rows = rows.observe(seen, F.collect_set(MONTH).alias("months"))
        else:
            self._note_uncompacted(months)
        if not whole:
            self._writer(rows, "append").parquet(self.path)
            if seen is not None:
                self._note_uncompacted(seen.get["months"])
            return
        self._writer(rows, "overwrite").parquet(self._staging)
        if seen is not None:
            self._note_uncompacted(seen.get["months"])
        self._intend("append", [(UNDATED_MONTH, 0)])
        self._add_staged()

    def landed(self, batch: DataFrame) -> DataFrame:
        """``batch`` computed once and read back from the table's own folder, until :meth:`discard_landed`."""
        folder = f"{self.path}/_lakeload/batch"
        batch.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(batch.schema).parquet(folder)

    def discard_landed(self) -> None:
        """Free what :meth:`landed` wrote."""
        no_rows(self.spark, self.schema).write.mode("overwrite").parquet(f"{self.path}/_lakeload/batch")

    def merge(
        self,
        batch: DataFrame,
        mark: tuple[datetime, datetime, datetime] | None = None,
        months: Iterable[int] | None = None,
        by_modification: bool = False,
    ) -> int:
        """Add conformed rows and keep the newest version of every record.

        With ``by_modification`` the latest modification wins however late the
        other versions were loaded, which batches in any order need.

        ``mark`` is (first, last, value): the sync mark of all rows modified in
        that range, set in the same rewrite, so data and mark appear together.
        ``months`` are the batch's months if already known. Returns the rows
        now in the rewritten months.
        """
        require_same_columns(batch.schema, self.schema)
        self.recover()
        batch = with_month(batch, self.contract.date_column)
        if months is None:
            months = [r[0] for r in batch.select(MONTH).distinct().collect()]
        touched = set(months)
        if self.contract.scope == "primary_key":  # a sort key contains the date, hence the month
            touched.update(self._months_of_records(batch))
        if mark is not None:
            touched.update(self.months(self._modified_between(mark[0], mark[1])))
        both = self._read(touched).unionByName(batch)
        merged = latest_by_contract(both, self.contract, by_modification)
        if mark is not None:
            merged = mark_synced(
                merged, self.contract.synced_column, mark[2], self.contract.modified_column, mark[0], mark[1]
            )
        return self.replace(merged, touched)

    def upsert(self, batch: DataFrame) -> int:
        """Insert new records and replace those modified later in ``batch``, whatever month they are in.

        Unlike :meth:`merge`, a row that was not modified later changes
        nothing, however recently it was loaded.
        """
        require_same_columns(batch.schema, self.schema)
        self.recover()
        batch = with_month(batch, self.contract.date_column)
        touched = {r[0] for r in batch.select(MONTH).distinct().collect()} | set(self._months_of_records(batch))
        changed = upsert(self._read(touched), batch, [self.contract.primary_key], self.contract.modified_column)
        return self.replace(changed, touched)

    def _modified_between(self, first: datetime | str, last: datetime | str) -> Column:
        return F.col(self.contract.modified_column).between(to_second(ntz(first)), to_second(ntz(last)))

    def _months_of_records(self, batch: DataFrame) -> list[int]:
        """Months that hold versions of a batch's records, from the key column alone.

        Files are sorted by key, so the batch's key range lets statistics skip
        whatever lies outside it.
        """
        key = self.contract.primary_key
        first, last = batch.agg(F.min(key), F.max(key)).first()
        if first is None:
            return []
        known = self.read().where(F.col(key).between(F.lit(first), F.lit(last)))
        known = known.select(key, MONTH).join(batch.select(key), key, "left_semi")
        return [r[0] for r in known.select(MONTH).distinct().collect()]

    def compact(self, months: Iterable[int] | None = None, repair: bool = False) -> int:
        """Keep only the newest version of each record.

        By default in those months that hold several versions of some record, of
        the months that appends have touched since the last compaction; these
        were noted, so no key of another month is read (under primary-key scope,
        of months outside the noted ones' key range). ``repair`` looks at the
        keys of the whole table instead, as after an append whose driver died
        before its note. ``months`` forces certain ones.
        """
        alone = self.contract.scope == "sort_key"
        if months is not None and not alone:
            raise ValueError("one row per primary key concerns all months")
        self.recover()
        if months is None:
            noted = None
            if not repair:
                noted = set(self._noted())
                if noted and not alone:
                    noted.update(self._months_of_records(self._read(noted)))
            touched = set(self._months_with_versions(noted))
        else:
            touched = set(months)
        # versions of one record may lie in several months: those go together
        rows = self._rewrite(touched, lambda df: latest_by_contract(df, self.contract), split=alone)
        left = set() if months is None else set(self._noted()) - touched
        no_rows(self.spark, _MONTHS).write.mode("overwrite").parquet(self._uncompacted)
        self._note_uncompacted(left)
        return rows

    def _noted(self) -> list[int]:
        """Months that appends touched and no compaction has rewritten yet."""
        return [r[0] for r in read_or_empty(self.spark, self._uncompacted, _MONTHS).distinct().collect()]

    def _note_uncompacted(self, months: Iterable[int]) -> None:
        new = sorted(set(months) - set(self._noted()))
        if new:
            rows = self.spark.range(1).select(F.explode(F.array(*(F.lit(m).cast("int") for m in new))).alias(MONTH))
            rows.write.mode("append").parquet(self._uncompacted)

    def _months_with_versions(self, months: Iterable[int] | None = None) -> list[int]:
        """Months, of some or of all, that hold several versions of some record, from the key columns alone."""
        per_key = self.read(months).groupBy(*self.contract.key)
        if self.contract.scope == "sort_key":
            repeated = per_key.agg(F.count(F.lit(1)).alias("n"), F.max(MONTH).alias(MONTH)).where("n > 1")
        else:
            repeated = per_key.agg(F.count(F.lit(1)).alias("n"), F.collect_set(MONTH).alias("months"))
            repeated = repeated.where("n > 1").select(F.explode("months").alias(MONTH))
        return [r[0] for r in repeated.select(MONTH).distinct().collect()]

    def delete(self, predicate: str | Column) -> int:
        """Remove the rows a predicate holds for; other months are not rewritten."""
        self.recover()
        return self._rewrite(self.months(condition(predicate)), lambda df: delete_where(df, predicate))

    def mark(
        self, value: datetime | str, first: datetime | str | None = None, last: datetime | str | None = None
    ) -> int:
        """Set the sync mark of rows modified in a range, or of all rows."""
        self.recover()
        synced, modified = self.contract.synced_column, self.contract.modified_column
        if first is None:
            return self._rewrite(self.months(), lambda df: mark_synced(df, synced, value))
        touched = self.months(self._modified_between(first, last))
        return self._rewrite(touched, lambda df: mark_synced(df, synced, value, modified, first, last))

    def retain(self, as_of: date | datetime) -> int:
        """Drop rows past their retention: expired months whole, the boundary month by row."""
        years = self.contract.retention_years
        if years is None:
            return 0
        self.recover()
        boundary = month_number(as_of.replace(day=1, year=as_of.year - years))
        expired = [m for m in self.months(F.col(MONTH) <= boundary) if m != UNDATED_MONTH]
        kept = self.read([boundary]).where(retained(self.contract.date_column, str(as_of), years))
        return self.replace(kept, expired)

    def _rewrite(
        self, months: Iterable[int], change: Callable[[DataFrame], DataFrame], split: bool = True
    ) -> int:
        """Replace months by what ``change`` makes of them, in portions if need be."""
        months = sorted(months)
        size = self.months_at_once if split and self.months_at_once else max(len(months), 1)
        portions = [months[i : i + size] for i in range(0, len(months), size)]
        return sum(self.replace(change(self.read(portion)), portion) for portion in portions)

    def replace(self, df: DataFrame, months: Iterable[int]) -> int:
        """Make ``df`` the content of ``months``; returns its row count."""
        months = set(months)
        if not months:
            return 0
        month = month_bucket(F.col(self.contract.date_column))
        rows = self._shaped(df.select(*self.schema.names, month.alias(MONTH)))
        if not self._has_files(months):
            # nothing to lose, so no detour; interrupted, the months are emptied again
            self._intend("replace", [(m, 0) for m in sorted(months)])
            self._writer(rows, "append").parquet(self.path)
            self._settle()
            return self._read(months).count()
        self._writer(rows, "overwrite").parquet(self._staging)
        filled = {r[0]: r[1] for r in self._staged().groupBy(MONTH).count().collect()}
        if not set(filled) <= months:
            raise ValueError(f"rows belong to months {sorted(set(filled) - months)}, which are not being replaced")
        note = [(m, filled.get(m, 0)) for m in sorted(months)]
        self._intend("replace", note)
        self._swap(note)
        return sum(filled.values())

    def recover(self) -> bool:
        """Finish or undo what a dead driver left behind; True if there was anything."""
        note = self._pending()
        if note and note[0]["action"] == "append":
            self._add_staged()
        elif note:
            self._swap([(r[MONTH], r["n_rows"]) for r in note])
        return bool(note)

    def _pending(self) -> list:
        """The note of a change that isn't finished; empty otherwise. One small file at most."""
        if not path_exists(self.spark, self._note):
            return []
        return read_or_empty(self.spark, self._note, _NOTE).collect()

    def _intend(self, action: str, note: list[tuple[int, int]]) -> None:
        """Note down what is about to happen to the table."""
        values = ", ".join(f"('{action}', {m}, {n}L)" for m, n in note)
        rows = self.spark.sql(f"SELECT * FROM VALUES {values} AS note(action, {MONTH}, n_rows)")
        rows.write.mode("overwrite").parquet(self._note)

    def _settle(self) -> None:
        no_rows(self.spark, _NOTE).write.mode("overwrite").parquet(self._note)

    def _add_staged(self) -> None:
        self._writer(self._staged(), "append").parquet(self.path)
        self._settle()
        self._discard_staged()

    def _swap(self, note: list[tuple[int, int]]) -> None:
        """Put the staged months in place; doing it twice gives the same table."""
        if any(n for _, n in note):
            # every staged file lies in one month, so this copy needs no shuffle
            self._writer(self._staged(), "overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
        # an overwrite by month leaves months without new rows as they were
        emptied = [f"{self.path}/{MONTH}={month}" for month, n in note if n == 0]
        nothing = no_rows(self.spark, self.schema)
        with ThreadPoolExecutor(_PARALLEL_WRITES) as pool:
            list(pool.map(lambda folder: nothing.write.mode("overwrite").parquet(folder), emptied))
        self._settle()
        self._discard_staged()

    def _discard_staged(self) -> None:
        no_rows(self.spark, self.schema).write.mode("overwrite").parquet(self._staging)

    def _staged(self) -> DataFrame:
        return read_or_empty(self.spark, self._staging, self._stored)

    def _writer(self, rows: DataFrame, mode: str) -> DataFrameWriter:
        writer = rows.write.mode(mode).partitionBy(MONTH)
        if self.bloom_keys is not None:
            writer = bloom_filtered(writer, self.contract.primary_key, self.bloom_keys)
        return writer

    def _shaped(self, df: DataFrame) -> DataFrame:
        """Well-sized files: small months in one, a large month in several, sorted by key.

        Rebalancing splits a month of any size at run time, where partitioning
        by month would put it into one task; the order lets row-group
        statistics serve key lookups.
        """
        return df.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, self.contract.primary_key)
