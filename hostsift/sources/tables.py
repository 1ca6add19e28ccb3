"""Cache, manifest and metadata tables: SQLite, JSON, JSON lines, CSV, Parquet."""

from __future__ import annotations

import sqlite3

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual,
)

# The cache tables' columns and keys.
CACHE_TABLES: dict[str, tuple[str, list[str]]] = {
    "root_domain_classification_history": (
        "domain string, classification string, statuses string, statuses_complete int, checked_at string, expires_at string", ["domain"],
    ),
    "dns_history": (
        "host string, resolver_key string, a_exists int, a_nodata int, a_nxdomain int, a_timeout int, a_servfail int, canonical_name string, "
        "ipv4_addresses string, ipv6_addresses string, checked_at string, expires_at string", ["host", "resolver_key"],
    ),
    "geo_history": (
        "provider string, ip string, country_code string, region_code string, region_name string, checked_at string, expires_at string", ["provider", "ip"],
    ),
}


#: Filters that SQLite can decide, as its comparisons.
_COMPARISONS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


class _Range(InputPartition):
    """Rows whose ordering column lies from ``low`` on and below ``high``; None leaves a side open."""

    def __init__(self, low, high):
        super().__init__((low, high))
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    """Reads a table by ranges of one column, one range a task; comparisons of a column with a value are left to SQLite.

    The ranges' ends are members of the column at even steps, found in its index, so ranges
    hold about as many rows each, and tables without a rowid are read as well.
    """

    def __init__(self, schema, options: dict):
        self.names = [f.name for f in schema.fields]
        self.path, self.table, self.parts = options["path"], options["table"], int(options.get("partitions", 8))
        self.by = options.get("by") or CACHE_TABLES.get(self.table, ("", ["rowid"]))[1][0]
        self.where, self.values = [], []

    def _connect(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def pushFilters(self, filters):
        for f in filters:
            name = f'"{f.attribute[0]}"' if len(getattr(f, "attribute", ())) == 1 else None
            plain = lambda v: isinstance(v, (str, int, float)) and not isinstance(v, bool)
            if name and type(f) in _COMPARISONS and plain(f.value):
                self.where.append(f"{name} {_COMPARISONS[type(f)]} ?")
                self.values.append(f.value)
            elif name and isinstance(f, In) and 0 < len(f.value) <= 500 and all(plain(v) for v in f.value):
                self.where.append(f"{name} IN ({', '.join('?' * len(f.value))})")
                self.values += f.value
            elif name and isinstance(f, IsNotNull):
                self.where.append(f"{name} IS NOT NULL")
            else:
                yield f

    def _clause(self, more: list[str]) -> str:
        return " WHERE " + " AND ".join([*self.where, *more]) if self.where or more else ""

    def partitions(self):
        by = self.by if self.by == "rowid" else f'"{self.by}"'
        with self._connect() as c:
            count = c.execute(f'SELECT count(*) FROM "{self.table}"{self._clause([])}', self.values).fetchone()[0]  # noqa: S608
            step = max(1, -(-count // self.parts))
            found = [
                c.execute(f'SELECT {by} FROM "{self.table}"{self._clause([f"{by} IS NOT NULL"])} ORDER BY {by} LIMIT 1 OFFSET ?', (*self.values, at)).fetchone()  # noqa: S608
                for at in range(step, count, step)
            ]
        ends = [None, *dict.fromkeys(r[0] for r in found if r), None]
        return [_Range(low, high) for low, high in zip(ends, ends[1:], strict=False)]

    def read(self, partition):
        by = self.by if self.by == "rowid" else f'"{self.by}"'
        more, values = [], list(self.values)
        if partition.low is not None:
            more.append(f"{by} >= ?")
            values.append(partition.low)
        if partition.high is not None:  # the first range has the rows without a value
            more.append(f"({by} < ?" + (f" OR {by} IS NULL)" if partition.low is None else ")"))
            values.append(partition.high)
        columns = ", ".join(f'"{n}"' for n in self.names)
        with self._connect() as c:
            yield from c.execute(f'SELECT {columns} FROM "{self.table}"{self._clause(more)}', values)  # noqa: S608


class SqliteSource(DataSource):
    """``spark.read.format("sqlite_table").option("path", …).option("table", …)``"""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        return CACHE_TABLES[self.options["table"]][0]

    def reader(self, schema):
        return SqliteReader(schema, self.options)


def sqlite_table(spark: SparkSession, path: str, table: str, schema: str | None = None, partitions: int = 8, by: str = "") -> DataFrame:
    """A table as a relation; filters on it reach SQLite."""
    spark.dataSource.register(SqliteSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("sqlite_table").option("path", path).option("table", table).option("partitions", partitions).option("by", by)
    return (reader.schema(schema) if schema else reader).load()


def cached_row(spark: SparkSession, path: str, table: str, key: dict[str, str]) -> DataFrame:
    """The row of one key, read through the table's index."""
    rows = sqlite_table(spark, path, table, partitions=1)
    for name, value in key.items():
        rows = rows.filter(F.col(name) == value)
    return rows


def ordered_roots(cache: DataFrame) -> DataFrame:
    return cache.select("domain").orderBy("domain")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON objects; blank lines give none."""
    text = spark.read.text(path).filter(F.trim("value") != "")
    return text.select(F.from_json("value", schema).alias("r")).select("r.*")


def manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A whole-file JSON object; anything but an object is an error when the row is read."""
    raw = spark.read.text(path, wholetext=True)
    body = F.when(F.trim("value").startswith("{"), F.col("value")).otherwise(F.raise_error(F.lit("a manifest must be a JSON object")))
    return raw.select(F.from_json(body, schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def review_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', nullValue="\x00", emptyValue="")


def prepared_metadata(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries by source, root plans) of a prepared-metadata file."""
    entry = "struct<host:string, registrable_domain:string, input_name:string, public_suffix:string, is_public_suffix_input:boolean, input_kind:string, apex_scope:string, source_format:string, line_index:int>"
    schema = f"prepared_source_ids array<string>, sources map<string, struct<source_index:int, entries:array<{entry}>>>, rdap_roots map<string, struct<status:string, authoritative_base_url:string>>"
    whole = manifest(spark, path, schema)
    entries = whole.select(F.explode("sources").alias("source_id", "s")).select("source_id", "s.source_index", F.inline("s.entries"))
    roots = whole.select(F.explode("rdap_roots").alias("root", "p")).select("root", F.coalesce("p.status", F.lit("unknown")).alias("status"), "p.authoritative_base_url")
    return entries, roots
