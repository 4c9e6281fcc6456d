"""Table contracts: the declared shape of a warehouse table.

A contract is a ``StructType`` plus the few table-level facts the operators
need. What Spark types cannot say (unsigned ranges, SQL defaults) sits in the
field metadata, under the same default key Spark uses for catalog tables, so a
contract can equally be read from ``spark.table(name).schema``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, types as T

DECLARED = "declared"
DEFAULT = "CURRENT_DEFAULT"

# Warehouse type names and the Spark type that holds each.
# Unsigned types use the next wider signed type.
SPARK_TYPES: dict[str, T.DataType] = {
    "String": T.StringType(),
    "Int8": T.ByteType(),
    "Int16": T.ShortType(),
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "UInt8": T.ShortType(),
    "UInt16": T.IntegerType(),
    "UInt32": T.LongType(),
    "UInt64": T.LongType(),
    "Float32": T.FloatType(),
    "Float64": T.DoubleType(),
    "Boolean": T.BooleanType(),
    "Date": T.DateType(),
    "DateTime": T.TimestampNTZType(),
    "Enum8": T.StringType(),
    "Enum16": T.StringType(),
    "UUID": T.StringType(),
}

# The retail source tables. Every one has primary key RECID,
# version updated_at, sync mark last_synced_at and five years of retention;
# they differ in the date that orders, partitions and expires their rows.
RETAIL_DATE_COLUMNS = {
    "custinvoicejour": "INVOICEDATE",
    "custinvoicetrans": "INVOICEDATE",
    "custtable": "CREATEDDATETIME",
    "retailchanneltable": "CREATEDDATETIME",
    "retailtendertypetable": "CREATEDDATETIME",
    "retailtransactiondiscounttrans": "MODIFIEDDATETIME",
    "retailtransactionpaymenttrans": "TRANSDATE",
    "retailtransactionsalestrans": "TRANSDATE",
    "retailtransactiontable": "TRANSDATE",
    "salesline": "CREATEDDATETIME",
    "vtasalestable": "CREATEDDATETIME",
}
# The table without a modification time, and landed file names
# that do not follow the table name.
RETAIL_WITHOUT_MODIFIED = {"vtasalestable"}
RETAIL_FILE_STEMS = {"retailtransactiondiscounttrans": "RETAILTRANSACTIONDISCOUNTTR"}


@dataclass(frozen=True)
class TableContract:
    """Declared columns and keys of one warehouse table.

    ``scope`` decides what counts as the same record: ``sort_key`` keeps the
    newest row per (primary key, date) within a month, so a record whose date
    moves leaves a row behind; ``primary_key`` keeps one row per record.
    ``null_date`` is ``null`` or ``epoch``: what a missing non-nullable date
    becomes.
    """

    name: str
    schema: T.StructType
    primary_key: str
    date_column: str | None = None
    version_column: str | None = "updated_at"
    modified_column: str | None = "MODIFIEDDATETIME"
    synced_column: str | None = "last_synced_at"
    retention_years: int | None = 5
    scope: str = "sort_key"
    null_date: str = "null"
    tiebreak: tuple[str, ...] | None = field(default=None)

    def __post_init__(self) -> None:
        if self.scope not in ("sort_key", "primary_key"):
            raise ValueError(f"unknown scope {self.scope!r}")
        if self.null_date not in ("null", "epoch"):
            raise ValueError(f"unknown null_date {self.null_date!r}")
        named = [self.primary_key, self.date_column, self.version_column, self.modified_column, self.synced_column]
        missing = [c for c in named if c is not None and c not in self.schema.names]
        if missing:
            raise ValueError(f"{self.name}: contract names undeclared columns {missing}")

    @property
    def key(self) -> list[str]:
        if self.scope == "primary_key" or self.date_column in (None, self.primary_key):
            return [self.primary_key]
        return [self.primary_key, self.date_column]

    def but(self, **changes: object) -> TableContract:
        return replace(self, **changes)


def column(name: str, declared: str, default: str | None = None) -> T.StructField:
    """One contract column from a warehouse type such as ``Nullable(UInt32)``."""
    inner = re.fullmatch(r"Nullable\((.+)\)", declared.strip())
    base = (inner.group(1) if inner else declared).strip()
    number = re.fullmatch(r"Decimal\((\d+),\s*(\d+)\)", base)
    if number:
        spark_type: T.DataType = T.DecimalType(int(number.group(1)), int(number.group(2)))
    else:
        kind = re.sub(r"\(.*\)$", "", base)  # Enum8('a' = 1) lists its values
        if kind not in SPARK_TYPES:
            raise ValueError(f"column {name}: unknown type {declared!r}")
        spark_type, base = SPARK_TYPES[kind], kind
    metadata = {DECLARED: base}
    if default:
        metadata[DEFAULT] = default
    return T.StructField(name, spark_type, inner is not None, metadata)


def declared_type(f: T.StructField) -> str:
    """The warehouse type of a field; plain Spark fields map to their own kind."""
    if DECLARED in f.metadata:
        return f.metadata[DECLARED]
    for name, spark_type in SPARK_TYPES.items():
        if spark_type == f.dataType:
            return name
    if isinstance(f.dataType, T.DecimalType):
        return f"Decimal({f.dataType.precision},{f.dataType.scale})"
    raise ValueError(f"column {f.name}: no warehouse type for {f.dataType.simpleString()}")


def integer_bounds(f: T.StructField) -> tuple[int, int] | None:
    """Least and greatest value of an integer column, as far as Spark can hold it."""
    kind = re.fullmatch(r"(U?)Int(\d+)", declared_type(f))
    if not kind:
        return None
    bits = int(kind.group(2))
    if kind.group(1):
        return 0, min(2**bits, 2**63) - 1
    return -(2 ** (bits - 1)), 2 ** (bits - 1) - 1


def default_primary_key(columns: Sequence[str]) -> str:
    """Primary key of a table nobody configured: RECID, else the first column."""
    if not columns:
        raise ValueError("table has no columns")
    return "RECID" if "RECID" in columns else columns[0]


def contract_from_description(name: str, rows: Iterable[Sequence[str]], **facts: object) -> TableContract:
    """Contract from a table description: (name, type, default kind, default text) rows."""
    fields = []
    for row in rows:
        kind, text = (row[2], row[3]) if len(row) > 3 else ("", "")
        fields.append(column(row[0], row[1], text if kind == "DEFAULT" else None))
    return _contract(name, T.StructType(fields), facts)


def contract_from_table(spark: SparkSession, table: str, **facts: object) -> TableContract:
    """Contract of a catalog table, with the column defaults Spark stores.

    A column's comment may name its warehouse type, as :func:`create_table`
    writes it. Defaults of text are SQL literals there and plain text here; the
    instant of the insert is ``now()``.
    """
    fields = []
    for f in spark.table(table).schema:
        metadata = dict(f.metadata)
        kind = metadata.pop("comment", None)
        if kind is not None and (kind in SPARK_TYPES or re.fullmatch(r"Decimal\(\d+,\s*\d+\)", kind)):
            metadata[DECLARED] = kind
        default = metadata.get(DEFAULT)
        if default and "current_timestamp" in default.lower():
            metadata[DEFAULT] = "now()"
        elif default and isinstance(f.dataType, T.StringType):
            metadata[DEFAULT] = spark.sql(f"SELECT CAST({default} AS STRING)").first()[0]
        fields.append(T.StructField(f.name, f.dataType, f.nullable, metadata))
    return _contract(table.split(".")[-1], T.StructType(fields), facts)


def create_table(spark: SparkSession, contract: TableContract, table: str, path: str) -> None:
    """A Parquet catalog table of a contract at ``path``, its defaults declared to the catalog.

    Spark then fills columns that an insert leaves out (:func:`insert_into`).
    ``now()`` becomes the instant of the insert in UTC; defaults that are no SQL
    of their type are text.
    """
    spark.sql(f"CREATE TABLE {table} ({', '.join(_column_ddl(spark, f) for f in contract.schema)}) USING parquet LOCATION '{path}'")


def _column_ddl(spark: SparkSession, f: T.StructField) -> str:
    name, text = "`" + f.name.replace("`", "``") + "`", f.metadata.get(DEFAULT)
    comment = f" COMMENT '{declared_type(f)}'"
    if not text:
        return f"{name} {f.dataType.simpleString()}{comment}"
    if "now()" in text:
        value = "to_utc_timestamp(current_timestamp(), current_timezone())" if isinstance(f.dataType, T.TimestampType) else f"CAST(to_utc_timestamp(current_timestamp(), current_timezone()) AS {f.dataType.simpleString()})"
    elif isinstance(f.dataType, T.StringType):
        quoted = text.replace("\\", "\\\\").replace("'", "\\'")
        value = f"'{quoted}'"
    else:
        value = f"CAST({text} AS {f.dataType.simpleString()})"
    return f"{name} {f.dataType.simpleString()} DEFAULT {value}{comment}"


def insert_into(df: DataFrame, table: str) -> None:
    """Insert ``df`` by column names; the catalog's defaults fill the columns it lacks."""
    view = f"insert_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    names = ", ".join("`" + c.replace("`", "``") + "`" for c in df.columns)
    try:
        df.sparkSession.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {view}")
    finally:
        df.sparkSession.catalog.dropTempView(view)


def contract_from_schema(name: str, schema: T.StructType, **facts: object) -> TableContract:
    return _contract(name, schema, facts)


def _contract(name: str, schema: T.StructType, facts: dict) -> TableContract:
    facts = dict(facts)
    facts.setdefault("primary_key", default_primary_key(schema.names))
    for fact, usual in (
        ("version_column", "updated_at"),
        ("modified_column", "MODIFIEDDATETIME"),
        ("synced_column", "last_synced_at"),
    ):
        facts.setdefault(fact, usual if usual in schema.names else None)
    return TableContract(name=name, schema=schema, **facts)


def retail_contract(table: str, description: Iterable[Sequence[str]], **facts: object) -> TableContract:
    """Contract of one of the eleven retail tables.

    The columns (up to 230 a table) come from the warehouse's own description;
    keys, dates and retention are the fixed values above.
    """
    facts.setdefault("date_column", RETAIL_DATE_COLUMNS[table])
    contract = contract_from_description(table, description, **facts)
    if (contract.modified_column is None) != (table in RETAIL_WITHOUT_MODIFIED):
        raise ValueError(f"{table}: unexpected presence or absence of MODIFIEDDATETIME")
    return contract


def landed_path(root: str, table: str) -> str:
    """Where the landing job leaves the file of a retail table."""
    stem = RETAIL_FILE_STEMS.get(table, table.upper())
    return f"{root.rstrip('/')}/raw/{stem}.parquet"
