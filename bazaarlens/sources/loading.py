"""Full refresh of the nine tables from a folder of CSV extracts."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bazaarlens.operators import dedup_keep_first, fk_orphans, pk_violations, spread_join
from bazaarlens.schemas import BY_NAME, TABLES, Table
from bazaarlens.session import DROP_SHUFFLES, materialize, release, remove_at_exit, remove_folder, shared_folder
from bazaarlens.sources import versions
from bazaarlens.sources.csv_files import CORRUPT, FILE, LINE, Unreadable, faulty_column, read_csv_positional, same_cuts

# How many places of faults an error names.
_PLACES = 10
# So many broken keys, of at most some dozens of bytes each, are sent to the tasks that look for them.
_FEW_KEYS = 100_000
# For the rows under judgement, stored by the task that read them: what is joined to them by task and number comes to
# them, in a hash table where it is small, and a task writes its one bucket without a sort.
# Rows lie on disk up to three times while they are loaded, so they are stored small, and what a job has shuffled goes with it.
_SETTINGS = {
    "spark.sql.parquet.compression.codec": "zstd",
    **DROP_SHUFFLES,
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.maxConcurrentOutputFileWriters": "2",
}


@dataclass(frozen=True)
class Place:
    """A fault: the line its record begins in, counted from 1, and the column, where one is to blame."""

    file: str
    line: int
    column: str | None
    rule: str

    def __str__(self) -> str:
        return f"{self.file}, line {self.line}" + (f", {self.column}" if self.column else "") + f": {self.rule}"


class LoadError(Exception):
    """A table broke its rules; ``problems`` maps each broken rule to the number of cases, ``places`` are the
    first of them in the files."""

    def __init__(self, table: str, problems: Mapping[str, int], places: Iterable[Place] = ()):
        self.table, self.problems, self.places = table, dict(problems), list(places)
        counted = ", ".join(f"{rule}: {n}" for rule, n in self.problems.items())
        super().__init__("\n".join([f"{table}: {counted}", *map(str, self.places)]))


def load_plan(spark: SparkSession, folder: str) -> list[tuple[Table, str | None]]:
    """Each table, parents first, with the file found for it, or None.

    A table's file is ``<table>.csv``, with any prefix ending in ``_`` and an optional
    ``_dataset`` behind the name. It may also be a folder of part files, the better form for
    large extracts. Two that fit one table are refused.
    """
    return [(table, _file(spark, folder, table)) for table in TABLES]


def _file(spark: SparkSession, folder: str, table: Table) -> str | None:
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder}/{{,*_}}{table.name}{{,_dataset}}.csv")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [str(status.getPath()) for status in files.globStatus(pattern) or []]
    if len(found) > 1:
        raise LoadError(table.name, {"more than one extract": len(found)}, [])
    return found[0] if found else None


def load(
    spark: SparkSession,
    folder: str,
    database: str,
    target: str,
    strict: bool = True,
    buckets: int | None = None,
    first: str = "earliest",
    at_once: int = 6,
    remove_read: bool = False,
) -> DataFrame:
    """Replace all tables of ``database`` by the extracts in ``folder`` and return the row counts.

    Tables are written as Parquet under ``target``, each as a new version that readers see once it has
    been checked (see `versions`). First all tables are empty, at once, and a table without a file stays so. With
    ``strict``, the first table that breaks a rule stays empty and a LoadError is raised, which says where;
    tables before it are there, those after it empty. Otherwise every row read is either in its
    table or in ``<table>_rejected``, with the reason, the file, the line and the column.

    ``buckets`` writes orders, items and customers in that many buckets by their id, which saves
    the reports the largest shuffles. Choose it so that one bucket fits a task comfortably.

    ``first`` says which of several rows of a key stays, where a table keeps one: the ``earliest`` by
    its dates, or the first ``in_file`` (by path, then by line).

    Up to ``at_once`` tables are loaded at the same time; a child waits for its parents before its references are
    checked. They are published in their order, so what readers see does not depend on it.

    ``remove_read`` removes the extracts one by one, so that rows need not lie on disk as text and in tables at the same time: a
    lenient load removes one as soon as its rows are stored, a strict load when its table keeps all rules. A load
    that fails afterwards does not bring them back, so it is for copies and for extracts that can be had again.
    """
    if first not in ("earliest", "in_file"):
        raise ValueError(f"first is earliest or in_file, not {first}")
    plan = load_plan(spark, folder)
    version = versions.new_version()
    versions.begin(spark, database, target, version)
    running: dict[str, Future] = {}
    counts = dict.fromkeys(BY_NAME, 0)
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        for table, path in plan:
            # Parents were submitted before, so whoever waits for one waits for a load that has begun.
            parents = {name: running[name] for name in table.references.values()}
            task = _TableLoad(spark, table, path, database, target, version, strict, buckets, first, parents, remove_read)
            running[table.name] = pool.submit(task.run)
        try:
            for table, path in plan:
                counts[table.name] = running[table.name].result()
                if path:
                    versions.publish(spark, database, table.name, version, version)
        except BaseException:
            for future in running.values():
                future.cancel()
            spark.sparkContext.cancelJobsWithTag(version)
            raise
        finally:
            pool.shutdown()
            _drop_unpublished(spark, database, version)
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")


def load_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The number of rows of each table."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.union, counts)


def _drop_unpublished(spark: SparkSession, database: str, version: str) -> None:
    seen = versions.published(spark, database)
    for table in TABLES:
        name = versions.stored_name(table.name, version)
        for stored in (name, f"{name}{versions.REJECTED}"):
            if seen.get(table.name) != version and spark.catalog.tableExists(f"{database}.{stored}"):
                versions.drop(spark, database, stored)


@dataclass
class _TableLoad:
    """The load of one table up to a checked version that is not published."""

    spark: SparkSession
    table: Table
    path: str | None
    database: str
    target: str
    version: str
    strict: bool
    buckets: int | None
    first: str
    parents: Mapping[str, Future]
    remove_read: bool

    def run(self) -> int:
        """Write and check the version; the number of its rows."""
        if not self.path:
            return 0
        # A session of its own: settings that hold while files are cut concern no other table's jobs.
        spark, self.spark = self.spark, self.spark.newSession()
        for name, value in spark.conf.getAll.items():
            if spark.conf.isModifiable(name):
                self.spark.conf.set(name, value)
        self.spark.sparkContext.addJobTag(self.version)
        self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", self.table.name)
        for name, value in _SETTINGS.items():
            self.spark.conf.set(name, value)
        stored: list[DataFrame] = []
        try:
            return (self._strict if self.strict else self._lenient)(stored)
        except Unreadable as error:
            place = Place(error.file, error.line, None, "unreadable")
            raise LoadError(self.table.name, {"unreadable": 1}, [place]) from error
        finally:
            release(*stored)
            judged = f"{versions.stored_name(self.table.name, self.version)}{versions.JUDGED}"
            if self.spark.catalog.tableExists(f"{self.database}.{judged}"):
                versions.drop(self.spark, self.database, judged)
            self.spark.sparkContext.removeJobTag(self.version)

    def _parents(self) -> dict[str, DataFrame]:
        """The versions of this load, once they are checked; a table without a file has the empty one.

        Until then a child has been read already, and its rows judged one by one.
        """
        found = {}
        for parent, load in self.parents.items():
            load.result()
            name = f"{self.database}.{versions.stored_name(parent, self.version)}"
            there = self.spark.catalog.tableExists(name)
            found[parent] = self.spark.table(name if there else f"{self.database}.{versions.stored_name(parent, versions.EMPTY)}")
        return found

    def _write(self, rows: DataFrame, counted: Mapping[str, Column]) -> tuple[DataFrame, dict[str, int]]:
        """The rows as this version, and the counts that were taken while they were written. Of rows under judgement, those
        set aside become its rejected rows."""
        table, buckets = self.table, self.buckets if self.table.cluster_by else None
        counts = _Counts(counted)
        columns = [c.name for c in table.columns]
        if self.strict:
            name = versions.create(self.spark, self.database, self.target, table, self.version, buckets)
            counts.over(self._dealt(rows.select(*columns))).write.insertInto(name)
        elif buckets:
            name = versions.create(self.spark, self.database, self.target, table, self.version, buckets)
            taken = self._dealt(rows.filter("reason IS NULL").select(*columns, "reason"))
            counts.over(taken).drop("reason").write.insertInto(name)
            rejected = versions.create_rejected(self.spark, self.database, self.target, table, self.version, rows.schema)
            rows.filter("reason IS NOT NULL").write.insertInto(rejected)
        else:
            # Both in one pass, each in a folder of its own; the places of rows taken are not kept.
            place = versions.create_apart(self.spark, self.database, self.target, table, self.version, rows.schema)
            taken = F.col("reason").isNull()
            rows = rows.withColumns({c: F.when(~taken, F.col(c)) for c in rows.columns if c not in columns})
            counts.over(rows.withColumn(versions.TAKEN, taken)).write.partitionBy(versions.TAKEN).parquet(place, mode="append")
            name = f"{self.database}.{versions.stored_name(table.name, self.version)}"
        return self.spark.table(name), counts.found()

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """One file per bucket: rows are brought together by the same hash the buckets use."""
        dealt = self.buckets and self.table.cluster_by
        return rows.repartition(self.buckets, self.table.cluster_by) if dealt else rows

    # Strict loads

    def _strict(self, stored: list[DataFrame]) -> int:
        """Rules on single rows are counted while the rows are written, keys and references after that."""
        table = self.table
        try:
            places = bool(table.keep_first) and self.first == "in_file"
            rows = read_csv_positional(self.spark, self.path, table.schema, True, stored, places)
            rules = _row_rules(table)
            if table.keep_first:
                # Rows that will be dropped must keep the column rules, too.
                counts = _Counts(_column_rules(table))
                with same_cuts(self.spark):
                    stored.append(rows := materialize(counts.over(rows)))
                self._refuse(counts.found())
                rows = dedup_keep_first(rows, table.key, [FILE, LINE] if places else table.keep_first)
            written, found = self._write(rows, {_ROWS: F.lit(True), **rules})
            _release_all(stored)
            n_rows = found.pop(_ROWS, 0)
            broken = list(_found(_sets(written, table, self._parents()), stored))
            self._refuse(found | {name: n for name, _, _, n in broken}, broken, written)
            self._has_read()
            return n_rows
        except (PySparkException, Py4JJavaError) as error:
            if "MALFORMED_RECORD" not in str(error):
                raise
            raise self._error({"unreadable": 1}) from error

    def _refuse(self, problems: Mapping[str, int], broken: Sequence[_Broken] = (), written: DataFrame | None = None) -> None:
        if problems:
            raise self._error(problems, broken, written)

    def _error(self, problems: Mapping[str, int], broken: Sequence[_Broken] = (), written: DataFrame | None = None) -> LoadError:
        """The file is read once more, leniently, to find where the faults are. No row is stored for that, and rows are
        joined to the ``broken`` keys, found in the ``written`` rows, by these keys and their places alone."""
        stored: list[DataFrame] = []
        try:
            unreadable = "unreadable" in problems
            faulty = faulty_column(self.table.schema) if unreadable else F.lit(None).cast("string")
            keys = dict.fromkeys(key for _, on, _, _ in broken for key in on)
            judged = self._rows(stored).select(FILE, LINE, "reason", faulty.alias("_faulty"), *keys)
            for name, on, found, n in broken:
                judged = _marked(judged, found.select(*on, F.lit(name).alias("_broken")), on, n, written)
                judged = judged.withColumn("reason", F.coalesce("reason", "_broken")).drop("_broken")
            counts = _Counts({"unreadable": F.col("reason") == "unreadable"} if unreadable else {})
            judged = counts.over(judged).filter(F.col("reason").isin(*problems))
            column = _column(self.table, F.col("_faulty"))
            with same_cuts(self.spark):
                rows = judged.select(FILE, LINE, column.alias("column"), "reason").orderBy(FILE, LINE).limit(_PLACES).collect()
            return LoadError(self.table.name, counts.found() if unreadable else problems, [Place(*row) for row in rows])
        finally:
            release(*stored)

    # Lenient loads

    def _lenient(self, stored: list[DataFrame]) -> int:
        table = self.table
        judged = self._judged(stored)
        outcome = judged.select(
            *[c.name for c in table.columns], CORRUPT, "reason",
            F.col(FILE).alias("file"), F.col(LINE).alias("line"), _column(table).alias("column"),
        )
        _, found = self._write(outcome, {_ROWS: F.col("reason").isNull()})
        return found.get(_ROWS, 0)

    def _judged(self, stored: list[DataFrame]) -> DataFrame:
        """All rows with the ``reason`` to set them aside, NULL for those that keep all rules.

        A row is set aside for the first rule it breaks: its columns, then its key, then its references.
        All rows of a repeated key are, unless the table says which one to keep: then that choice comes
        last, among the rows that keep all other rules, and the others are a ``repeated key``.

        Rows are stored once. Repeated keys and references without a parent are found from their keys alone; if there
        are none, which is usual, no row is joined to anything. ``stored`` gets what can be released after the load.
        """
        table = self.table
        base = self._stored(self._rows(stored))
        _release_all(stored)
        self._has_read()
        sets = _sets(base.filter("reason IS NULL"), table, self._parents(), repeated=not table.keep_first)
        judged = self._set_aside(base, list(_found(sets, stored)), base, stored)
        return self._keep_one(judged, base, stored) if table.keep_first else judged

    def _has_read(self) -> None:
        """The extract is not read again."""
        if self.remove_read:
            remove_folder(self.spark, self.path)

    def _rows(self, stored: list[DataFrame]) -> DataFrame:
        """All rows with their places and, as ``reason``, the first rule on single rows that they break."""
        rows = read_csv_positional(self.spark, self.path, self.table.schema, False, stored, places=True)
        reason = F.when(F.col(CORRUPT).isNotNull(), "unreadable")
        for name, broken in _row_rules(self.table).items():
            reason = reason.when(broken, name)
        return rows.withColumn("reason", reason)

    def _stored(self, rows: DataFrame) -> DataFrame:
        """The rows, stored in buckets by the task that read them and numbered within it.

        What is found out about rows later is joined to them by these two numbers. Only that is shuffled then: the rows
        stay in the files in which they lie.
        """
        spark = self.spark
        path = f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}"
        remove_at_exit(spark, path)
        name = f"{self.database}.{versions.stored_name(self.table.name, self.version)}{versions.JUDGED}"
        # In fewer buckets than a shuffle has parts Spark would deal the rows out anew.
        parts = spark.conf.get("spark.sql.shuffle.partitions")
        buckets = max(int(parts), int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", parts)))
        within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("int")
        rows = rows.withColumns({_TASK: F.spark_partition_id(), _NUMBER: within})
        with same_cuts(spark):
            rows.write.format("parquet").option("path", path).bucketBy(buckets, _TASK).saveAsTable(name)
        return spark.table(name)

    def _set_aside(self, judged: DataFrame, found: Sequence[_Broken], base: DataFrame, stored: list[DataFrame]) -> DataFrame:
        """``judged`` with the first of the broken rules of ``found`` as the reason of rows that have none.

        Few broken keys are sent to the tasks. With many, rows are joined to them as their keys and numbers alone.
        """
        good, ranks, ids = base.filter("reason IS NULL"), [], []
        for rank, (_, keys, broken, n) in enumerate(found):
            marked = broken.select(*keys, F.lit(rank).alias(f"_{rank}"))
            if n <= _FEW_KEYS:
                judged = judged.join(F.broadcast(marked), keys, "left")
                ranks.append(f"_{rank}")
            else:
                rows = spread_join(good.select(*keys, _TASK, _NUMBER), marked, keys, [_TASK, _NUMBER], counted=good)
                ids.append(rows.select(_TASK, _NUMBER, F.col(f"_{rank}").alias("_many")))
        if ids:
            many = reduce(DataFrame.unionAll, ids).repartition(_TASK).groupBy(_TASK, _NUMBER).agg(F.min("_many").alias("_many"))
            stored.append(many := materialize(many))
            judged = judged.join(many, [_TASK, _NUMBER], "left")
            ranks.append("_many")
        if not ranks:
            return judged
        first = F.least(*ranks) if len(ranks) > 1 else F.col(ranks[0])
        names = F.array(*[F.lit(name) for name, *_ in found])
        return judged.withColumn("reason", F.coalesce("reason", F.get(names, first))).drop(*ranks)

    def _keep_one(self, judged: DataFrame, base: DataFrame, stored: list[DataFrame]) -> DataFrame:
        """Of the good rows of a key all but the first are a repeated key."""
        key = list(self.table.key)
        order = [] if self.first == "in_file" else self.table.keep_first
        # NULLs last, as a value that orders after all others.
        values = [F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("value")).alias(f"_{c}") for c in order]
        here = F.struct(_TASK, _NUMBER)
        good = judged.filter("reason IS NULL")
        # Found from the keys alone; rows with their values, long texts among them, are only compared if there are any.
        repeated = good.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*key)
        for _, _, keys, n in _found({_REPEATED: (key, repeated)}, stored):
            compared = good.join(F.broadcast(keys), key) if n <= _FEW_KEYS else good
            least = F.min(F.struct(*values, FILE, LINE, here.alias("here")))["here"]
            firsts = compared.groupBy(*key).agg(least.alias("_first"), F.count(F.lit(1)).alias("_n"))
            stored.append(found := materialize(firsts.filter("_n > 1").select(*key, "_first")))
            if n <= _FEW_KEYS:
                judged = judged.join(F.broadcast(found), key, "left")
                repeated = F.when(F.col("_first").isNotNull() & (here != F.col("_first")), _REPEATED)
                judged = judged.withColumn("reason", F.coalesce("reason", repeated)).drop("_first")
            else:
                rows = spread_join(good.select(*key, _TASK, _NUMBER), found, key, [_TASK, _NUMBER], counted=base)
                stored.append(others := materialize(rows.filter(here != F.col("_first")).select(_TASK, _NUMBER)))
                judged = judged.join(others.withColumn("_others", F.lit(_REPEATED)), [_TASK, _NUMBER], "left")
                judged = judged.withColumn("reason", F.coalesce("reason", "_others")).drop("_others")
        return judged


_ROWS = "rows"
_REPEATED = "repeated key"
# The task that stored a row, and the row's number among those of the task.
_TASK, _NUMBER = "_task", "_number"
# A rule on several rows, its columns, the keys that break it, and their number.
_Broken = tuple[str, list[str], DataFrame, int]


def _release_all(stored: list[DataFrame]) -> None:
    """Remove what was stored to read the rows, once these are stored themselves."""
    release(*stored)
    stored.clear()


class _Counts:
    """Numbers of rows that are counted while something else is done with them.

    The counts are of the last job's tasks, so put them behind the last shuffle: a task that is repeated there counts once.
    """

    def __init__(self, rules: Mapping[str, Column]):
        self._rules = dict(rules)
        self._seen = Observation()

    def over(self, rows: DataFrame) -> DataFrame:
        counts = [F.count_if(rule).alias(f"c{i}") for i, rule in enumerate(self._rules.values())]
        return rows.observe(self._seen, *counts) if counts else rows

    def found(self) -> dict[str, int]:
        """What was counted, without zeros."""
        if not self._rules:
            return {}
        counted = self._seen.get
        return {rule: counted[f"c{i}"] for i, rule in enumerate(self._rules) if counted.get(f"c{i}")}


def _found(sets: Mapping[str, tuple[list[str], DataFrame]], stored: list[DataFrame]) -> Iterator[_Broken]:
    """(name, keys, rows, number) of the sets that hold anything; they are computed in one job."""
    if not sets:
        return
    named = [rows.select(F.lit(name).alias("_set"), F.struct(*[F.col(c) for c in rows.columns]).alias(f"_{i}"))
             for i, (name, (_, rows)) in enumerate(sets.items())]
    together = materialize(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named))
    stored.append(together)
    counts = {r["_set"]: r["count"] for r in together.groupBy("_set").count().collect()}
    for i, (name, (keys, _)) in enumerate(sets.items()):
        if counts.get(name):
            yield name, keys, together.filter(F.col("_set") == name).select(f"_{i}.*"), counts[name]


def _marked(rows: DataFrame, marked: DataFrame, keys: list[str], n: int, base: DataFrame) -> DataFrame:
    """``rows`` with the columns of the ``n`` ``marked`` keys."""
    if n <= _FEW_KEYS:
        return rows.join(F.broadcast(marked), keys, "left")
    return spread_join(rows, marked, keys, [FILE, LINE], "left", counted=base)


def broken_rules(rows: DataFrame, table: Table, parents: Mapping[str, DataFrame]) -> dict[str, int]:
    """Each rule of ``table`` that ``rows`` break, with the number of cases.

    One pass for the rules on single rows; the key and all references in one further job, with
    a shuffle of counted values for each.
    """
    counted = rows.agg(*[F.count_if(broken).alias(rule) for rule, broken in _row_rules(table).items()]).first().asDict()
    return {rule: cases for rule, cases in counted.items() if cases} | broken_sets(rows, table, parents)


def broken_sets(rows: DataFrame, table: Table, parents: Mapping[str, DataFrame]) -> dict[str, int]:
    """The rules on several rows that ``rows`` break: the key and all references, in one job."""
    sets = _sets(rows, table, parents)
    sizes = [found.agg(F.count(F.lit(1)).alias("cases")).withColumn("rule", F.lit(rule)) for rule, (_, found) in sets.items()]
    counted = {r.rule: r.cases for r in reduce(DataFrame.union, sizes).collect()} if sizes else {}
    return {rule: cases for rule, cases in counted.items() if cases}


def _sets(
    rows: DataFrame, table: Table, parents: Mapping[str, DataFrame], repeated: bool = True
) -> dict[str, tuple[list[str], DataFrame]]:
    """The rules on several rows, each with its columns and the keys in ``rows`` that break it."""
    sets = {}
    if table.key and repeated:
        sets["duplicate key"] = (list(table.key), pk_violations(rows.select(*table.key), table.key))
    for column, parent in table.references.items():
        orphans = fk_orphans(rows, column, parents[parent], column).withColumnRenamed("reference", column)
        sets[f"{column} not in {parent}"] = ([column], orphans)
    return sets


def _column_rules(table: Table) -> dict[str, Column]:
    """What a row's columns must keep even before one of several rows is chosen."""
    rules = {f"{c} missing": F.col(c).isNull() for c in table.required}
    return rules | {f"{c} longer than {n}": F.char_length(c) > n for c, n in table.max_lengths.items()}


def _row_rules(table: Table) -> dict[str, Column]:
    """Rule name to the condition under which a row breaks it."""
    rules = _column_rules(table)
    rules |= {f"{c} not in {low}..{high}": ~F.col(c).between(low, high) for c, (low, high) in table.ranges.items()}
    return rules


def _column(table: Table, faulty: Column | None = None) -> Column:
    """The column that a row's ``reason`` is about; NULL if it is about several, or the whole record.
    ``faulty`` is that of an unreadable row, if it is known."""
    single = {rule: rule.split(" ")[0] for rule in _row_rules(table)}
    single |= {f"{column} not in {parent}": column for column, parent in table.references.items()}
    single |= {rule: table.key[0] for rule in ("duplicate key", _REPEATED) if len(table.key) == 1}
    column = F.when(F.col("reason") == "unreadable", faulty_column(table.schema) if faulty is None else faulty)
    for rule, name in single.items():
        column = column.when(F.col("reason") == rule, name)
    return column
