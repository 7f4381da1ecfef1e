"""CSV in and out.

A quoted field may hold line breaks, so where a line of a file begins a record depends on all quotes before it.
Files are read in splits all the same. Whether a split begins within a quoted field follows from what each split
before it does to that state: it leaves it as it is, turns it round, or ends in one whatever it was. These are found
for all splits side by side, put together along each file, and known when the splits are cut into records. A record
that crosses splits is joined from its fragments, of which a split has two at most.
"""

import bisect
import csv
import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tenderlens.session import materialise

# From within a quoted field to behind its end, and from elsewhere to behind the quote that begins the next one.
_CLOSE = re.compile(r'[^"]*+(?:""[^"]*+)*+"')
_OPEN = re.compile(r'[,\r]"')
_WHOLE, _BEGINS, _GOES_ON, _ENDS = range(4)
_PARTS = "file bigint, block bigint, kind int, is_first boolean, value string"


def ends_quoted(line: str, quoted: bool) -> bool:
    """Whether a line ends within a quoted field, given whether it begins in one."""
    if '"' not in line:
        return quoted
    at = 0
    if not quoted:
        if not line.startswith('"'):
            found = _OPEN.search(line)
            if not found:
                return False
            at = found.end()
        else:
            at = 1
    while True:
        found = _CLOSE.match(line, at)
        if not found:
            return True
        # What follows up to the next comma belongs to the field, quotes included.
        found = _OPEN.search(line, found.end())
        if not found:
            return False
        at = found.end()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Array]]:
    """(file, block, lines): stretches of lines of one split, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        begins = np.flatnonzero(np.r_[True, (file[1:] != file[:-1]) | (block[1:] != block[:-1])])
        for a, b in zip(begins, [*begins[1:], batch.num_rows]):
            yield int(file[a]), int(block[a]), batch.column(2).slice(a, b - a)


def _texts(lines: pa.Array) -> list[str]:
    return [raw.decode("utf-8", "replace") for raw in lines.cast("binary").to_pylist()]


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split, the state at its end for either state at its beginning."""
    names = ["file", "block", "from_plain", "from_quoted"]
    now, states = None, (False, True)

    def row():
        return pa.RecordBatch.from_pylist([dict(zip(names, (*now, *states)))], pa.schema([("file", pa.int64()), ("block", pa.int64()), ("from_plain", pa.bool_()), ("from_quoted", pa.bool_())]))

    for file, block, lines in _runs(batches):
        if (file, block) != now:
            if now is not None:
                yield row()
            now, states = (file, block), (False, True)
        for line in _texts(lines):
            states = ends_quoted(line, states[0]), ends_quoted(line, states[1])
    if now is not None:
        yield row()


def _changes(lines: DataFrame) -> dict[int, tuple[list[int], list[bool]]]:
    """Per file, the splits that end in another state than they begin in, and that state.

    At most an entry per split, so one for some 128 MB of text.
    """
    effects = lines.filter(F.contains("value", F.lit('"'))).mapInArrow(_effects, "file bigint, block bigint, from_plain boolean, from_quoted boolean")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("from_plain") == F.col("from_quoted")
    turns = (F.col("from_plain") & ~F.col("from_quoted")).cast("int")
    counted = effects.withColumn("turns", F.sum(turns).over(order)).withColumn("own", turns)
    last = F.last(F.when(fixed, F.struct(F.col("from_plain").alias("state"), F.col("turns").alias("turns"))), ignorenulls=True).over(before)
    known = counted.withColumn("last", last)
    since = F.col("turns") - F.col("own") - F.coalesce("last.turns", F.lit(0))
    known = known.withColumn("start", F.coalesce("last.state", F.lit(False)) != (since % 2 == 1))
    known = known.withColumn("end", F.when(F.col("start"), F.col("from_quoted")).otherwise(F.col("from_plain")))
    found: dict[int, tuple[list[int], list[bool]]] = {}
    for row in known.filter("start <> end").select("file", "block", "end").orderBy("file", "block").toLocalIterator():
        blocks, states = found.setdefault(row.file, ([], []))
        blocks.append(row.block)
        states.append(row.end)
    return found


def _cutter(changes: dict[int, tuple[list[int], list[bool]]], fragments: bool):
    """Task function that yields the whole records of splits, or the fragments of those that cross splits."""

    def state_at(file: int, block: int) -> bool:
        blocks, states = changes.get(file, ((), ()))
        place = bisect.bisect_left(blocks, block)
        return states[place - 1] if place else False

    def batch_of(file, block, kind, first, values) -> pa.RecordBatch:
        many = len(values)
        values = values if isinstance(values, pa.Array) else pa.array(values, pa.string())
        is_first = pa.array([first] + [False] * (many - 1), pa.bool_())
        arrays = [pa.array(np.full(many, file, np.int64)), pa.array(np.full(many, block, np.int64)), pa.array(np.full(many, kind, np.int32)), is_first, values]
        return pa.RecordBatch.from_arrays(arrays, names=["file", "block", "kind", "is_first", "value"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, held, kind = None, False, [], _WHOLE

        def rest():
            if held and fragments:
                yield batch_of(*now, _GOES_ON if kind == _ENDS else _BEGINS, first, ["\n".join(held)])

        for file, block, lines in _runs(batches):
            if (file, block) != now:
                yield from rest()
                now, first, held = (file, block), block == 0, []
                quoted = state_at(file, block)
                kind = _ENDS if quoted else _WHOLE
            if not quoted and not pc.any(pc.match_substring(lines, '"')).as_py() and _clean(lines):
                if not fragments:
                    yield batch_of(file, block, _WHOLE, first, lines)
                first = False
                continue
            whole, whole_first = [], first
            for line in _texts(lines):
                held.append(line)
                quoted = ends_quoted(line, quoted)
                if not quoted:
                    value = held[0] if len(held) == 1 else "\n".join(held)
                    if kind == _WHOLE:
                        whole.append(value)
                    elif fragments:
                        yield batch_of(file, block, _ENDS, False, [value])
                    held, kind, first = [], _WHOLE, False
            if whole and not fragments:
                yield batch_of(file, block, _WHOLE, whole_first, whole)
        yield from rest()

    return cut


def _clean(lines: pa.Array) -> bool:
    """Whether all bytes are text, so that none need be replaced."""
    try:
        lines.validate(full=True)
    except pa.ArrowInvalid:
        return False
    return True


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, is_first, value): the records of CSV files as text, with the line breaks of their quoted fields.

    ``is_first`` marks the first record of each file. Undecodable bytes become replacement characters.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    changes = _changes(lines)
    whole = lines.mapInArrow(_cutter(changes, False), _PARTS).select("file", "is_first", "value")
    if not changes:
        return whole
    parts = materialise(lines.mapInArrow(_cutter(changes, True), _PARTS), "fragments")
    parts = parts.withColumn("begins", F.col("kind") == _BEGINS)
    order = Window.partitionBy("file").orderBy("block", "begins")
    parts = parts.withColumn("record", F.sum(F.col("begins").cast("int")).over(order))
    ordered = F.array_sort(F.collect_list(F.struct("block", "begins", "value")))
    joined = parts.groupBy("file", "record").agg(F.max("is_first").alias("is_first"), ordered.alias("parts"))
    return whole.unionAll(joined.select("file", "is_first", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value")))


# From narrow to wide.
_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _reads_as(value: Column, kind: str) -> Column:
    if kind == "date":
        return value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & value.try_cast(kind).isNotNull()
    return value.try_cast(kind).isNotNull()


def _inferred(texts: DataFrame, fields: list[Column], names: list[str]) -> T.StructType:
    """The narrowest type that reads all values of each column; text where none does or all are null."""
    counts = [F.count_if(_reads_as(value, kind)).alias(f"{i}_{kind}") for i, value in enumerate(fields) for kind in _TYPES]
    found = texts.agg(*[F.count(value).alias(f"{i}_all") for i, value in enumerate(fields)], *counts).first()
    schema = T.StructType()
    for i, name in enumerate(names):
        fitting = [kind for kind in _TYPES if found[f"{i}_all"] and found[f"{i}_{kind}"] == found[f"{i}_all"]]
        schema.add(name, _TYPES[fitting[0]] if fitting else T.StringType())
    return schema


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, quoted_newlines: bool = True) -> DataFrame:
    """A headered CSV. Without a schema the types are inferred, which reads the text twice.

    Line breaks in quoted fields are part of the field, and large files are read by many tasks.
    ``quoted_newlines=False`` leaves it to Spark's reader, for files that are known to have none. Blank lines are skipped.
    """
    if not quoted_newlines:
        reader = spark.read.option("header", True).option("escape", '"')
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        return reader.csv(path)
    found = records(spark, path).withColumn("value", F.rtrim("value", F.lit("\r")))
    body = found.filter(~F.col("is_first") & (F.trim("value") != ""))
    options = {"escape": '"', "multiLine": "true", "lineSep": "\n"}
    if schema is None:
        header = found.filter("is_first").select("value").first()
        if header is None:
            raise ValueError(f"no header in {path}")
        names = next(csv.reader([header.value]))
        texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        read = F.from_csv("value", texts.toDDL(), options)
        schema = _inferred(body.select(read.alias("row")), [F.col(f"row.c{i}") for i in range(len(names))], names)
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    plain = T.StructType([T.StructField(f"c{i}", field.dataType) for i, field in enumerate(kind)])
    rows = body.select(F.from_csv("value", plain.toDDL(), options).alias("row")).select("row.*")
    return rows.toDF(*kind.names)


def write_csv(df: DataFrame, path: str) -> str:
    """A headered CSV folder, one file per partition; returns the path."""
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.json(path)
    return path


def _fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fields of each record; a lone carriage return ends a record, too."""
    csv.field_size_limit(2**31 - 1)
    for batch in batches:
        rows = []
        for file, is_first, value in zip(*[column.to_pylist() for column in batch.columns]):
            if '"' in value or "\r" in value or not value:
                found = list(csv.reader(io.StringIO(value, newline=""))) or [[]]
            else:
                found = [value.split(",")]
            rows += [(file, is_first and i == 0, fields) for i, fields in enumerate(found)]
        columns = zip(*rows) if rows else ((), (), ())
        kinds = [pa.int64(), pa.bool_(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(columns, kinds)], names=["file", "is_header", "fields"])


def read_ragged_csv(spark: SparkSession, path: str) -> DataFrame:
    """A headered CSV whose rows differ in width, all columns text.

    The table is as wide as its widest row. Short rows are padded with empty text,
    surplus columns are named ``unknown_<i>``, a blank line is an all-empty row and
    undecodable bytes become replacement characters. A quoted field may hold line breaks and be of any length;
    large files are read by many tasks.
    """
    found = materialise(records(spark, path).mapInArrow(_fields, "file bigint, is_header boolean, fields array<string>"), "records")
    known = found.agg(F.max(F.size("fields")).alias("width"), F.min_by("fields", F.when(F.col("is_header"), F.col("file"))).alias("header")).first()
    if known.header is None:
        raise ValueError(f"no header in {path}")
    names = known.header + [f"unknown_{i}" for i in range(len(known.header), known.width)]
    body = found.filter("not is_header")
    return body.select(*[F.coalesce(F.get("fields", F.lit(i)), F.lit("")).alias(f"c{i}") for i in range(known.width)]).toDF(*names)
