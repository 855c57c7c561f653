"""CSV extracts: typed, by position, in parallel even where quoted fields hold line breaks."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bazaarlens.session import materialize

CORRUPT = "_corrupt_record"
# Where a row comes from, where asked for: the file's path and the line its record begins in, from 1.
FILE, LINE = "_file", "_line"

# A quoted empty field while reading: "" is an empty string, an unquoted empty field is NULL, and Spark's
# reader tells them apart only by a stand-in. It is as many of these as no line holds.
_MARK = "\u0001"

# Small files are cut into so many shares, if these are not too small; the same number on any cluster.
_SHARES = 200

# A record of more bytes within one split is taken for two stray quotes.
LONGEST_RECORD = 256 << 20


class Unreadable(ValueError):
    """A file that cannot be told apart into records of text; says where, if that is known."""

    def __init__(self, message: str, file: str, line: int):
        super().__init__(f"{message} in {file}, line {line}")
        self.file, self.line = file, line


class UnterminatedField(Unreadable):
    """Quotes do not pair up."""


class NoText(Unreadable):
    """Bytes that are no UTF-8, or NUL characters."""


def read_csv_positional(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType,
    strict: bool = True,
    stored: list[DataFrame] | None = None,
    places: bool = False,
) -> DataFrame:
    """Read CSV files with a header line, whose names are ignored, into the columns of ``schema``.

    ``strict`` makes any row that does not fit fail the job that reads it, and refuses files that hold
    other bytes than UTF-8 text. Otherwise such a row is kept as text in a further column,
    ``_corrupt_record``, with what is no text replaced. ``stored`` gets what the caller can release
    once the rows are read.

    ``places`` adds the columns ``_file`` and ``_line``. Such rows must be computed inside `same_cuts`.
    """
    if not strict:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    splits = _splits(spark, paths)
    if stored is not None:
        stored.append(splits)
    facts = _facts(splits)
    if strict and facts["no_text"]:
        raise NoText("bytes that are no text", facts["no_text"]["path"], facts["no_text"]["line"])
    standin = _MARK * (facts["marks"] + 1)
    options = _options(standin, strict)
    records_are_lines = not facts["breaks"]
    if records_are_lines and not places and not facts["no_text"]:
        rows = spark.read.schema(schema).options(**options, recursiveFileLookup="true").csv(paths, header=True)
    else:
        records = _line_records(spark, paths, splits) if records_are_lines and places else _records(spark, paths, splits, places, stored)
        whole = F.col("whole")
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        rows = records.withColumn("row", F.from_csv(F.when(whole, F.col("record")), columns, options))
        fields = {f.name: F.col(f"row.{f.name}") for f in schema.fields}
        if not strict:
            as_text = F.replace(F.make_valid_utf8("record"), F.lit("\0"), F.lit("\ufffd"))
            fields[CORRUPT] = F.when(whole, fields[CORRUPT]).otherwise(as_text)
        place = [F.col("path").alias(FILE), F.col("line").alias(LINE)] if places else []
        rows = rows.select(*[column.alias(name) for name, column in fields.items()], *place)
    texts = [f.name for f in schema.fields if isinstance(f.dataType, StringType) and f.name != CORRUPT]
    empty = F.lit(standin)
    return rows.withColumns({c: F.when(F.col(c) == empty, "").otherwise(F.col(c)) for c in texts})


def _options(standin: str, strict: bool) -> dict[str, str]:
    return {
        "quote": '"',
        "escape": '"',
        "nullValue": "",
        "emptyValue": standin,
        "mode": "FAILFAST" if strict else "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }


def faulty_column(schema: StructType) -> Column:
    """Of a row kept as text, the first column whose field does not fit its type; NULL where the number of
    fields is wrong, or none was read since the bytes are no text."""
    names = [f.name for f in schema.fields]
    texts = ", ".join(f"{name} string" for name in [*names, "_more"])
    fields = F.from_csv(CORRUPT, texts, _options(_MARK, strict=False))
    # A row of too few fields fits as far as it goes.
    misfits = [F.when(fields[name].isNotNull() & F.col(name).isNull(), name) for name in names]
    none_read = F.coalesce(*[F.col(name).cast("string") for name in names]).isNull()
    return F.when(F.col(CORRUPT).isNotNull() & fields["_more"].isNull() & ~none_read, F.coalesce(*misfits))


@contextmanager
def same_cuts(spark: SparkSession) -> Iterator[None]:
    """Cut files by bytes alone, as long as a job runs: by default the cuts follow the number of cores."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(_SHARES))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All lines, each with its file (a hash of the path) and the split it starts in; within a split
    they come in order, and ``row`` counts them up.

    A record is open after a line if the quotes up to there are odd in number; a doubled quote
    inside a field leaves that as it is.
    """
    return (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .text(paths)
        .select(
            F.xxhash64("_metadata.file_path").alias("file"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
            "value",
            (_number_of('"') % 2).alias("odd"),
            _is_text("value").alias("whole"),
        )
    )


def _number_of(sign: str) -> Column:
    """How often a sign of one byte stands in a line; most lines are only searched for it."""
    there = F.contains(F.col("value"), F.lit(sign))
    return F.when(there, F.octet_length("value") - F.octet_length(F.replace("value", F.lit(sign), F.lit("")))).otherwise(0)


def _is_text(column: str) -> Column:
    return F.is_valid_utf8(column) & ~F.contains(F.col(column), F.lit("\0"))


def _splits(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per file split: how many lines it has and which is its first, how many have an odd number of quotes, and
    what a reader must know of the others."""
    first_return = F.instr("value", "\r")
    inner_return = F.contains(F.col("value"), F.lit("\r")) & (first_return > 0) & (first_return < F.char_length("value"))
    # Grouped by the path: as a first value, a text, it would have every line sorted.
    with same_cuts(spark):
        return materialize(
            _lines(spark, paths)
            .groupBy("path", "split")
            .agg(
                F.count(F.lit(1)).alias("lines"),
                F.min("row").alias("first_row"),
                F.sum("odd").alias("odds"),
                F.max(F.when(F.col("odd") == 1, F.col("row"))).alias("last_odd"),
                F.bool_or(inner_return).alias("inner_return"),
                F.min(F.when(~F.col("whole"), F.col("row"))).alias("no_text"),
                F.max(_number_of(_MARK)).alias("marks"),
            )
            .withColumn("file", F.xxhash64("path"))
        )


def _earlier(what: str) -> Column:
    """The sum over the splits before a split of the same file."""
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(what).over(before), F.lit(0))


def _facts(splits: DataFrame) -> dict:
    """What decides how files are read: whether records hold line breaks, the first line that is no text, and the
    number of marks in a line. An unterminated field is refused here."""
    per_file = splits.groupBy("file").agg(
        F.sum("odds").alias("odds"), F.bool_or("inner_return").alias("returns"),
        F.count("no_text").alias("no_text"), F.max("marks").alias("marks"),
    )
    found = per_file.agg(
        F.coalesce(F.bool_or((F.col("odds") > 0) | F.col("returns")), F.lit(False)).alias("breaks"),
        F.coalesce(F.bool_or(F.col("odds") % 2 == 1), F.lit(False)).alias("unterminated"),
        F.coalesce(F.sum("no_text"), F.lit(0)).alias("no_text"),
        F.coalesce(F.max("marks"), F.lit(0)).alias("marks"),
    ).first()
    facts = found.asDict() | {"no_text": None}
    if found["unterminated"] or found["no_text"]:
        places = _faults(splits)
        if places["unterminated"]:
            raise UnterminatedField("unterminated quoted field", places["unterminated"]["path"], places["unterminated"]["line"])
        facts["no_text"] = places["no_text"]
    return facts


def _faults(splits: DataFrame) -> Row:
    """Path and line where the first unterminated field begins, and of the first line that is no text."""

    def line(row: str) -> Column:
        return F.col("lines_before") + F.col(row) - F.col("first_row") + 1

    per_file = (
        splits.withColumn("lines_before", _earlier("lines"))
        .groupBy("path")
        .agg(F.sum("odds").alias("odds"), F.max(line("last_odd")).alias("last_odd"), F.min(line("no_text")).alias("no_text"))
    )
    return per_file.agg(
        F.min(F.when(F.col("odds") % 2 == 1, F.struct("path", F.col("last_odd").alias("line")))).alias("unterminated"),
        F.min(F.when(F.col("no_text").isNotNull(), F.struct("path", F.col("no_text").alias("line")))).alias("no_text"),
    ).first()


def _lines_are_records(splits: DataFrame) -> bool:
    """Whether no record holds a line break, so that Spark's own reader can split the files."""
    return not _facts(splits)["breaks"]


def _entry(splits: DataFrame) -> DataFrame:
    """What a task must know of the splits it reads: a few numbers for each, and so per share of a scan task: less than
    the driver plans with anyway. A broadcast also leaves the lines in their order."""
    return F.broadcast(
        splits.select(
            "file", "split", "first_row", "lines", (_earlier("odds") % 2).cast("int").alias("open"), _earlier("lines").alias("lines_before")
        )
    )


def _record(text: str) -> Column:
    """The text without a return at its end; texts are only searched for one, as most hold none."""
    return F.when(F.contains(F.col(text), F.lit("\r")), F.regexp_replace(text, "\r$", "")).otherwise(F.col(text))


def _is_record() -> Column:
    """Blank lines are no records, as for Spark's own reader: those that hold nothing above a space. The first character
    mostly tells."""
    return (F.ascii("record") > 32) | F.col("record").rlike("[^\\x00-\\x20]")


def _line_records(spark: SparkSession, paths: str | list[str], splits: DataFrame) -> DataFrame:
    """record, whole, path and line of every record, headers left out, where each is a line."""
    lines = _lines(spark, paths).join(_entry(splits), ["file", "split"], "left")
    at = F.col("row") - F.col("first_row")
    changed = F.raise_error(F.lit("a file changed, or was cut otherwise, while it was read")).cast("long")
    inside = F.when((at >= 0) & (at < F.col("lines")), F.col("lines_before") + at + 1).otherwise(changed)
    records = lines.select(_record("value").alias("record"), "whole", "path", inside.alias("line"))
    return records.filter((F.col("line") > 1) & _is_record())


def _records(spark: SparkSession, paths: str | list[str], splits: DataFrame, places: bool, stored: list[DataFrame] | None) -> DataFrame:
    """record, whole, line and, with ``places``, path of every record, headers left out, from files cut anywhere into splits.

    Reading such files with ``multiLine`` takes one task per file. Here the quotes counted in the
    splits before a split tell whether it starts inside a record, and every task puts the lines
    of its splits together where it reads them, in one pass that is stored. Only the pieces at the
    borders of a split, at most two, are matched across splits: by their numbers alone, the text of
    a record is brought together afterwards. Texts are moved as bytes, so that what is no text stays.
    """
    lines = _lines(spark, paths).join(_entry(splits), ["file", "split"], "left")
    lines = lines.select("file", "split", "open", "odd", "lines_before", F.col("value").cast("binary").alias("value"))
    with same_cuts(spark):
        pieces = materialize(
            lines.mapInArrow(_pieces, "file long, split long, number long, line long, border boolean, text binary")
        )
    if stored is not None:
        stored.append(pieces)

    so_far = Window.partitionBy("file").orderBy("split", "number").rowsBetween(Window.unboundedPreceding, 0)
    starts = F.when(F.col("number") > 0, 1).otherwise(0)
    border = pieces.filter("border")
    numbered = border.select("file", "split", "number").withColumn("record", F.sum(starts).over(so_far))
    in_order = F.array_sort(F.collect_list(F.struct("split", "number", "line", "text")))
    joined = (
        border.join(numbered, ["file", "split", "number"])
        .groupBy("file", "record")
        .agg(in_order.alias("parts"))
        .select(
            "file",
            F.col("parts")[0]["split"].alias("split"),
            F.col("parts")[0]["number"].alias("number"),
            F.col("parts")[0]["line"].alias("line"),
            F.array_join(F.transform("parts", lambda x: x["text"].cast("string")), "\n").alias("text"),
        )
    )
    header = (F.col("split") == 0) & (F.col("number") == 1)
    inner = pieces.filter("not border").select("file", "split", "number", "line", F.col("text").cast("string").alias("text"))
    records = inner.unionByName(joined).filter(~header)
    # Judged as bytes, before an expression on characters replaces what is none.
    records = records.select("file", "line", _is_text("text").alias("whole"), _record("text").alias("record")).filter(_is_record())
    if not places:
        return records.drop("file")
    # One row per file, from one per split; a file's records stay where they are.
    names = splits.groupBy("file").agg(F.first("path").alias("path"))
    return records.join(F.broadcast(names), "file", "left").drop("file")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the lines of each split into records, numbered from 1 within the split.

    Piece 0 is the rest of a record that an earlier split began. It and the last piece of a split
    are at its border. Lines between two starts of records are joined by offsets, all at once.
    """
    at = None  # the split being read
    number, is_open = 0, 0
    pending: list[pa.Array] = []  # lines of the record that is not complete yet
    line, pending_line, size = 0, 0, 0  # of the next line, of the pending record's first, its bytes

    def closed(border: bool) -> list[pa.RecordBatch]:
        if not pending:
            return []
        text = b"\n".join(line for part in pending for line in part.to_pylist())
        return [_batch(*at, number, np.array([pending_line]), border, pa.array([text], pa.binary()))]

    for batch in batches:
        for run in _runs(batch):
            here = run["file"][0].as_py(), run["split"][0].as_py()
            if here != at:
                yield from closed(border=True)
                at, number, is_open, pending, size = here, 0, run["open"][0].as_py(), [], 0
                if is_open is None:
                    raise RuntimeError("a file changed while it was read")
                line = pending_line = run["lines_before"][0].as_py() + 1
            odd = run["odd"].to_numpy()
            odd_so_far = np.cumsum(odd)
            starts = np.flatnonzero((is_open + odd_so_far - odd) % 2 == 0)
            is_open = int(is_open + odd_so_far[-1]) % 2
            lines = run["value"]
            if not len(starts):
                pending.append(lines)
                size += lines.nbytes
                if size > LONGEST_RECORD:
                    raise ValueError(f"a record of more than {LONGEST_RECORD} bytes begins in line {pending_line}")
                line += len(lines)
                continue
            pending += [lines.slice(0, starts[0])] if starts[0] else []
            yield from closed(border=number == 0)
            between = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), lines) if len(starts) > 1 else None
            if between is not None:
                yield _batch(*at, number + 1, line + starts[:-1], False, pc.binary_join(between, b"\n"))
            number += len(starts)
            pending = [lines.slice(starts[-1])]
            pending_line, size = line + int(starts[-1]), pending[0].nbytes
            line += len(lines)
    yield from closed(border=True)


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut where the next line belongs to another split."""
    if not batch.num_rows:
        return
    split, file = batch["split"].to_numpy(), batch["file"].to_numpy()
    cuts = np.flatnonzero((split[1:] != split[:-1]) | (file[1:] != file[:-1])) + 1
    for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(begin, end - begin)


def _batch(file: int, split: int, number: int, lines: np.ndarray, border: bool, texts: pa.Array) -> pa.RecordBatch:
    """Pieces of one split, numbered from ``number`` on."""
    count = len(texts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(count, file)), pa.array(np.full(count, split)), pa.array(np.arange(number, number + count)),
            pa.array(lines, pa.int64()), pa.array(np.full(count, border)), texts.cast(pa.binary()),
        ],
        names=["file", "split", "number", "line", "border", "text"],
    )


# Tasks get these functions by value: a package on the driver's path alone is enough for the reader.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def corrupt_rows(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """The rows, as text, that do not fit ``schema``."""
    rows = read_csv_positional(spark, paths, schema, strict=False)
    # Compared with all columns in hand: Spark parses just the columns a query asks for.
    return rows.filter(F.col(CORRUPT).isNotNull()).select(*[f.name for f in schema.fields], CORRUPT)
