"""Column expressions and table helpers that several operators share."""

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tenderlens.session import scratch_path

# Words are runs of characters other than these blanks.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone; other columns may have any name, also one that differs only in case."""
    places = df.columns
    flat = df.toDF(*[f"c{i}" for i in range(len(places))])
    return flat.select(*[F.col(f"c{places.index(name)}").alias(name) for name in names])


def beside(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns as one struct ``row``, and new ones computed from ``row``."""
    packed = df.toDF(*[f"c{i}" for i in range(len(df.columns))]).select(F.struct("*").alias("row"))
    return packed.withColumns(columns) if columns else packed


def at(df: DataFrame, name: str) -> Column:
    """A column of ``df`` within the ``row`` of ``beside``."""
    return F.col(f"row.c{df.columns.index(name)}")


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns that ``beside`` packed, under their names."""
    return df.select("row.*").toDF(*like.columns)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches of a task in smaller ones, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def split_by_id(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often and deep inside it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bucketed(df: DataFrame, key: str, name: str, shuffle: bool = True) -> DataFrame:
    """``df`` as a table in the shared folder, in as many buckets of ``key`` as shuffles have partitions.

    Tables of one key are joined and grouped by it without a shuffle. ``shuffle`` deals the rows out by ``key`` first, for one
    file a bucket; without it a task writes a file for each bucket that it has rows of. The catalog forgets
    the table's name at once; its files stay until the folder goes.
    """
    spark = df.sparkSession
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 100_000)
    own = f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key) if shuffle else df
    dealt.write.bucketBy(buckets, key).format("parquet").option("path", scratch_path(spark, name)).saveAsTable(own)
    table = spark.table(own)
    table.schema  # resolved: from here on it holds its files, not the name
    spark.sql(f"DROP TABLE {own}")
    return table
