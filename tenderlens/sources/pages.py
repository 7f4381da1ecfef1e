"""Notices from landed search-result pages, and the predicates of a notice search."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tenderlens.functions import scalars as S
from tenderlens.schema import REQUESTED_FIELDS
from tenderlens.session import materialise

PAGE_ROWS = 100
MAX_PAGES = 5


_REJECTED = "_rejected_page"


def read_pages(
    spark: SparkSession,
    path: str,
    notice_schema: T.StructType | None = None,
    page_per_line: bool = False,
    most_rejected: float = 0.0,
    rejected_path: str | None = None,
) -> DataFrame:
    """One row per notice of the ``{"notices": [...]}`` documents below ``path``.

    A document is one page of bounded size: a file of its own, or with ``page_per_line``
    one line, which keeps large files splittable. Pages without notices give no rows.
    Without ``notice_schema`` the fields are inferred, which reads the pages once more.

    Pages that cannot be read, as a whole or in their notices, are counted first. The read fails if their share is
    above ``most_rejected``; otherwise their texts are written to ``rejected_path``, and the rest is read.
    """
    reader = spark.read.option("multiLine", not page_per_line)
    if notice_schema is None:
        found = reader.json(path).schema
        kind = found["notices"].dataType if "notices" in found.names else None
        kind = kind if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) else None
        kind = kind or T.ArrayType(T.StructType([T.StructField("notice-identifier", T.StringType())]))
    else:
        kind = T.ArrayType(notice_schema)
    schema = T.StructType([T.StructField("notices", kind), T.StructField(_REJECTED, T.StringType())])
    pages = reader.option("columnNameOfCorruptRecord", _REJECTED).schema(schema).json(path)
    bad = F.col(_REJECTED).isNotNull()
    counts = pages.agg(F.count("*").alias("pages"), F.count_if(bad).alias("rejected"), F.count("notices")).first()
    if counts.rejected:
        if counts.rejected > most_rejected * counts.pages:
            raise ValueError(f"{counts.rejected} of {counts.pages} pages below {path} cannot be read")
        if rejected_path:
            in_part = F.col("notices").isNotNull().alias("read_in_part")
            aside = pages.filter(bad).select(F.col("_metadata.file_path").alias("file"), in_part, F.col(_REJECTED).alias("page"))
            aside.write.mode("append").json(rejected_path)
    return pages.filter(~bad).select(F.explode("notices").alias("notice")).select("notice.*")


def _as_text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    if isinstance(kind, T.BooleanType):
        return F.when(value, "True").when(~value, "False")
    return value.cast("string")


def _item_text(kind: T.DataType):
    return lambda item: _as_text(item, kind)


def flatten(df: DataFrame) -> DataFrame:
    """Structs one level deep become ``outer.inner`` columns, lists pipe-joined text."""
    out = []
    for field in df.schema:
        value = S.col(field.name)
        if isinstance(field.dataType, T.StructType):
            for inner in field.dataType:
                leaf = value.getField(inner.name)
                if isinstance(inner.dataType, (T.StructType, T.ArrayType, T.MapType)):
                    leaf = F.to_json(leaf)
                out.append(leaf.alias(f"{field.name}.{inner.name}"))
        elif isinstance(field.dataType, T.ArrayType):
            texts = F.transform(value, _item_text(field.dataType.elementType))
            out.append(F.array_join(texts, "|", "None").alias(field.name))
        else:
            out.append(value.alias(field.name))
    return df.select(*out)


def requested(df: DataFrame) -> DataFrame:
    """The requested fields that are present."""
    return df.select(*[S.col(name) for name in REQUESTED_FIELDS if name in df.columns])


def published_between(df: DataFrame, start: str, end: str, country: str | None = None) -> DataFrame:
    """Notices published from ``start`` to ``end`` inclusive, of one buyer country if given."""
    day = S.col("publication-date")
    kept = df.filter((day >= F.lit(start).cast("timestamp")) & (day < F.lit(end).cast("date") + F.expr("interval 1 day")))
    return kept.filter(S.col("organisation-country-buyer") == country) if country else kept


def looking_back(df: DataFrame, days: int = 30, as_of: str | None = None) -> DataFrame:
    """Notices of the last ``days`` days up to ``as_of``."""
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    start = F.date_sub(now.cast("date"), days).cast("timestamp")
    return df.filter((S.col("publication-date") >= start) & (S.col("publication-date") <= now))


def within_budget(df: DataFrame, limit: float) -> DataFrame:
    """Notices without a value or with one of at most ``limit``; unreadable values are dropped."""
    value = S.col("total-value")
    if isinstance(df.schema["total-value"].dataType, T.StringType):
        absent = value.isNull() | (value == "")
    else:
        absent = value.isNull()
    return df.filter(absent | (value.try_cast("double") <= F.lit(float(limit))))


def first_pages(df: DataFrame, pages: int = MAX_PAGES, rows: int = PAGE_ROWS) -> DataFrame:
    """The rows of pages 1 to ``pages``, in date and id order."""
    return df.orderBy("publication-date", "notice-identifier").limit(pages * rows)


def page(df: DataFrame, number: int, rows: int = PAGE_ROWS) -> DataFrame:
    return df.orderBy("publication-date", "notice-identifier").offset((number - 1) * rows).limit(rows)


class PageIndex:
    """A table kept in date and id order, of which any page is read without the pages before it.

    Rows are dealt out into ranges of the order and carry their place within their range; a small table has the
    number of rows before each range. Rows that agree in date and id follow each other by their other values. A page
    reads the ranges it lies in, and of those only the places it covers.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.rows_path, self.ranges_path = spark, f"{path}/rows", f"{path}/ranges"

    @classmethod
    def build(cls, df: DataFrame, path: str) -> "PageIndex":
        index = cls(df.sparkSession, path)
        keys = [S.col("publication-date"), S.col("notice-identifier"), F.xxhash64(*[S.col(name) for name in df.columns])]
        ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        place = F.monotonically_increasing_id() % (1 << 33)
        ordered.withColumns({"_range": F.spark_partition_id(), "_place": place}).write.partitionBy("_range").parquet(index.rows_path)
        counts = df.sparkSession.read.parquet(index.rows_path).groupBy("_range").agg(F.count("*").alias("rows"))
        # One row per range.
        before = F.sum("rows").over(Window.orderBy("_range")) - F.col("rows")
        counts.withColumn("before", before).coalesce(1).write.parquet(index.ranges_path)
        return index

    def page(self, number: int, rows: int = PAGE_ROWS) -> DataFrame:
        """Page ``number``, from 1; pages beyond the last are empty."""
        begin, end = (number - 1) * rows, number * rows
        ranges = self.spark.read.parquet(self.ranges_path).filter((F.col("before") < end) & (F.col("before") + F.col("rows") > begin))
        places = [
            (F.col("_range") == r["_range"]) & (F.col("_place") >= max(0, begin - r.before)) & (F.col("_place") < end - r.before)
            for r in ranges.collect()  # each has a row of the page at least
        ]
        stored = self.spark.read.parquet(self.rows_path)
        return stored.filter(reduce(lambda a, b: a | b, places, F.lit(False))).orderBy("_range", "_place").drop("_range", "_place")


def union_pages(pages: list[DataFrame]) -> DataFrame:
    """All rows of all pages, duplicates kept, over the union of their columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def write_pages(df: DataFrame, path: str, rows: int = PAGE_ROWS) -> None:
    """Write flat notices as page documents of at most ``rows`` notices each, one per line.

    Rows are numbered within their partition, so no page grows past its size and pages
    build in parallel. The numbers are written down before the shuffle, so a lost task
    cannot number its rows differently.
    """
    number = F.floor(F.monotonically_increasing_id() / rows)
    numbered = materialise(df.withColumn("_page", number), "numbered")
    notices = F.collect_list(F.struct(*[S.col(name) for name in df.columns]))
    documents = numbered.groupBy("_page").agg(notices.alias("notices"))
    documents.select(F.to_json(F.struct("notices")).alias("value")).write.text(path)
