"""Versions of a database's tables, and which of them readers see.

A load writes every table as a new version, a table of its own in the catalog (`orders_v3f…`), which no
reader knows of. Which version of which table counts is one property of the database. It is replaced whole by one
statement, so a reader, who asks for it once, sees all tables as of one moment. The tables' plain names are
views of the same versions, for SQL; they follow one after the other.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from bazaarlens.schemas import BY_NAME, TABLES, Table
from bazaarlens.session import remove_folder

EMPTY = "empty"
REJECTED = "_rejected"
# Rows under judgement, as long as a load runs.
JUDGED = "_judged"
# Rows taken and rows set aside, where they are written in one pass: two folders of one version, by this column.
TAKEN = "taken"

_VERSIONS = "bazaarlens.versions"
_LOAD = "bazaarlens.load"


class open_tables(Mapping):  # noqa: N801 - used like a function
    """The loaded tables of a database by name, all as they are at this moment, opened when asked for.

    A load that ends later does not show in them; open them again for that. What they read stays
    until the load after the next begins.
    """

    def __init__(self, spark: SparkSession, database: str):
        self._spark, self._database = spark, database
        self._versions = published(spark, database)

    def __getitem__(self, name: str) -> DataFrame:
        table = BY_NAME[name].name
        version = self._versions.get(table)
        return self._spark.table(f"{self._database}.{stored_name(table, version) if version else table}")

    def __iter__(self) -> Iterator[str]:
        return iter(BY_NAME)

    def __len__(self) -> int:
        return len(BY_NAME)


def stored_name(table: str, version: str) -> str:
    return f"{table}_v{version}"


def new_version() -> str:
    return uuid.uuid4().hex[:12]


def _properties(spark: SparkSession, database: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED {database}").collect()
    text = next((r.info_value for r in rows if r.info_name == "Properties"), "")
    return {name: value for name in (_VERSIONS, _LOAD) for value in re.findall(rf"\({re.escape(name)},([^()]*)\)", text)}


def published(spark: SparkSession, database: str) -> dict[str, str]:
    """The version of each table that readers see; nothing for a database that no load has written."""
    return dict(entry.split("=") for entry in _properties(spark, database).get(_VERSIONS, "").split())


def begin(spark: SparkSession, database: str, target: str, load: str) -> None:
    """Let all tables be empty, at once. Versions seen until now stay for those who read them; older ones go."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in TABLES:
        create(spark, database, target, table, EMPTY)
    seen = published(spark, database)
    _publish(spark, database, {table.name: EMPTY for table in TABLES}, load)
    for table in TABLES:
        _show(spark, database, table.name, EMPTY)
        spark.sql(f"DROP VIEW IF EXISTS {database}.{table.name}{REJECTED}")
    known = "|".join(BY_NAME)
    for row in spark.sql(f"SHOW TABLES IN {database}").collect():
        found = re.fullmatch(rf"({known})_v([0-9a-f]{{12}})({REJECTED}|{JUDGED})?", row.tableName)
        if found and seen.get(found[1]) != found[2]:
            drop(spark, database, row.tableName)


def create(spark: SparkSession, database: str, target: str, table: Table, version: str, buckets: int | None = None) -> str:
    """A new, empty version of a table, and its name in the catalog; no reader sees it yet."""
    kept = table.cluster_by
    dealt = f"CLUSTERED BY ({kept}) SORTED BY ({kept}) INTO {buckets} BUCKETS" if buckets and kept else ""
    name = f"{database}.{stored_name(table.name, version)}"
    return _create(spark, name, table.schema, f"{target}/{table.name}/{version}", dealt)


def create_rejected(spark: SparkSession, database: str, target: str, table: Table, version: str, schema: StructType) -> str:
    """The table of the rows that are set aside from a version, and its name in the catalog."""
    name = f"{database}.{stored_name(table.name, version)}{REJECTED}"
    return _create(spark, name, schema, f"{target}/{table.name}/{version}{REJECTED}")


def create_apart(spark: SparkSession, database: str, target: str, table: Table, version: str, schema: StructType) -> str:
    """A version and the table of its rejected rows in one folder, which is returned: rows written there, parted by
    `TAKEN`, are in the one or the other. They go together."""
    name, place = f"{database}.{stored_name(table.name, version)}", f"{target}/{table.name}/{version}"
    _create(spark, name, table.schema, f"{place}/{TAKEN}=true")
    _create(spark, f"{name}{REJECTED}", schema, f"{place}/{TAKEN}=false")
    return place


def _create(spark: SparkSession, name: str, schema: StructType, place: str, dealt: str = "") -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {dealt} LOCATION '{place}'")
    return name


def drop(spark: SparkSession, database: str, name: str) -> None:
    """Remove a version with its files."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{name}").collect()
    place = next((r.data_type for r in described if r.col_name == "Location"), None)
    spark.sql(f"DROP TABLE {database}.{name}")
    if place:
        remove_folder(spark, re.sub(rf"/{TAKEN}=(true|false)/?$", "", place))


def publish(spark: SparkSession, database: str, table: str, version: str, load: str) -> None:
    """Let readers see this version of a table. Refused if another load has begun in the meantime."""
    if _properties(spark, database).get(_LOAD) != load:
        raise RuntimeError(f"another load of {database} has begun")
    _publish(spark, database, published(spark, database) | {table: version}, load)
    _show(spark, database, table, version)


def _publish(spark: SparkSession, database: str, versions: Mapping[str, str], load: str) -> None:
    entries = " ".join(f"{table}={version}" for table, version in versions.items())
    spark.sql(f"ALTER DATABASE {database} SET DBPROPERTIES ('{_VERSIONS}' = '{entries}', '{_LOAD}' = '{load}')")


def _show(spark: SparkSession, database: str, table: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT * FROM {database}.{stored_name(table, version)}")
    rejected = f"{stored_name(table, version)}{REJECTED}"
    if spark.catalog.tableExists(f"{database}.{rejected}"):
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{table}{REJECTED} AS SELECT * FROM {database}.{rejected}")
