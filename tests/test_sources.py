import csv
import io
import json
import random
from collections import Counter

import pytest

from pyspark.sql import functions as F, types as T

from tenderlens.functions import scalars as S
from tenderlens.sources import csvfiles, pages


def test_flatten(spark):
    schema = (
        "`notice-id` string, values struct<total:int,currency:string>, organization struct<name:string,country:string>, "
        "tags array<string>"
    )
    df = spark.createDataFrame([("123", (1000, "EUR"), ("Test Org", "DE"), ["urgent", "construction"])], schema)
    row = pages.flatten(df).first().asDict()
    assert row == {
        "notice-id": "123",
        "values.total": 1000,
        "values.currency": "EUR",
        "organization.name": "Test Org",
        "organization.country": "DE",
        "tags": "urgent|construction",
    }


def test_pages_one_per_file(spark, tmp_path):
    for number, ids in enumerate((["N123", "N124"], ["N125"])):
        page = {"notices": [{"notice-identifier": i, "total-value": "1000"} for i in ids]}
        (tmp_path / f"page{number}.json").write_text(json.dumps(page, indent=2))
    (tmp_path / "empty.json").write_text(json.dumps({"message": "no result"}))
    found = pages.read_pages(spark, str(tmp_path))
    assert sorted(r["notice-identifier"] for r in found.collect()) == ["N123", "N124", "N125"]
    kind = T.StructType().add("notice-identifier", "string")
    assert pages.read_pages(spark, str(tmp_path), kind).count() == 3


def test_pages_without_notices(spark, tmp_path):
    (tmp_path / "page.json").write_text(json.dumps({"message": "no result"}))
    assert pages.read_pages(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("schema", [None, T.StructType().add("notice-identifier", "string")])
def test_unreadable_pages(spark, tmp_path, schema):
    page = json.dumps({"notices": [{"notice-identifier": "N1"}]})
    lines = [page, '{"notices": [{"notice-identifier": "N2"', page, "{}", '{"notices": "none"}' if schema else "not json"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "pages.json").write_text("\n".join(lines) + "\n")
    with pytest.raises(ValueError, match="2 of 5 pages"):
        pages.read_pages(spark, str(tmp_path / "in"), schema, page_per_line=True, most_rejected=0.3)
    found = pages.read_pages(spark, str(tmp_path / "in"), schema, True, 0.4, str(tmp_path / "aside"))
    assert [tuple(r) for r in found.collect()] == [("N1",), ("N1",)]
    aside = spark.read.json(str(tmp_path / "aside")).collect()
    assert sorted(r.page for r in aside) == sorted([lines[1], lines[4]]) and all(r.file.endswith("pages.json") for r in aside)


def test_an_unreadable_file(spark, tmp_path):
    (tmp_path / "page.json").write_text('{"notices": [')
    with pytest.raises(ValueError):
        pages.read_pages(spark, str(tmp_path))


def test_flatten_booleans_in_lists(spark):
    df = spark.createDataFrame([([True, None, False], [1, 2], True)], "flags array<boolean>, numbers array<int>, flag boolean")
    assert tuple(pages.flatten(df).first()) == ("True|None|False", "1|2", True)


def test_page_index(spark, tmp_path):
    """Pages of a table with nulls, ties and a third of its rows alike."""
    draw = random.Random(1)
    rows = [(draw.choice([None, "2024-01-01", "2024-01-02"]), draw.choice([None, "a", "b"]), draw.randrange(3)) for _ in range(700)]
    rows += [("2024-01-01", "same", 1)] * 350
    df = spark.createDataFrame(rows, "`publication-date` string, `notice-identifier` string, v int").repartition(6)
    index = pages.PageIndex.build(df, str(tmp_path / "index"))
    read = [[tuple(r) for r in index.page(n, 100).collect()] for n in range(1, 13)]
    assert [len(own) for own in read] == [100] * 10 + [50, 0]
    together = [row for own in read for row in own]
    assert Counter(together) == Counter(rows)
    order = [(d is not None, d or "", i is not None, i or "") for d, i, _ in together]
    assert order == sorted(order)
    plan = index.page(7, 100)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "_range" in plan.split("PartitionFilters")[-1] and "GreaterThanOrEqual(_place" in plan


def test_budget(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "10"), ("d", "11"), ("e", "x")], "id string, `total-value` string")
    assert [r.id for r in pages.within_budget(df, 10).collect()] == ["a", "b", "c"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("N123", 1000, 'a "b", c'), ("N124", 2000, "FR")], "`notice-id` string, `total-value` bigint, country string")
    path = csvfiles.write_csv(df, str(tmp_path / "out"))
    assert sorted(csvfiles.read_csv(spark, path).collect()) == sorted(df.collect())
    assert sorted(csvfiles.read_csv(spark, path, df.schema).collect()) == sorted(df.collect())


def test_ragged_csv(spark, tmp_path):
    for name in ("one.csv", "two.csv"):
        (tmp_path / name).write_bytes(
            b'id,name\n1,"a, ""b"""\n2\n\n3,c,extra,,\nid,name\n4,\xff\n'
        )
    df = csvfiles.read_ragged_csv(spark, str(tmp_path))
    assert df.columns == ["id", "name", "unknown_2", "unknown_3", "unknown_4"]
    rows = sorted(tuple(r) for r in df.collect())
    once = [
        ("", "", "", "", ""),
        ("1", 'a, "b"', "", "", ""),
        ("2", "", "", "", ""),
        ("3", "c", "extra", "", ""),
        ("4", "�", "", "", ""),
        ("id", "name", "", "", ""),
    ]
    assert rows == sorted(once * 2)


def test_ragged_csv_of_even_width(spark, tmp_path):
    (tmp_path / "one.csv").write_text("id,name\n1,a\n2,b\n")
    assert [tuple(r) for r in csvfiles.read_ragged_csv(spark, str(tmp_path)).collect()] == [("1", "a"), ("2", "b")]


def test_union_keeps_all_columns_and_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(1, "y"), (1, "y")], "id int, b string")
    out = pages.union_pages([a, b])
    assert out.columns == ["id", "a", "b"] and out.count() == 3


def test_search_predicate_reaches_the_scan(spark, tmp_path):
    df = spark.range(10).select(
        F.col("id").cast("string").alias("notice-identifier"),
        F.lit("DE").alias("organisation-country-buyer"),
        F.lit("2024-01-01").cast("timestamp").alias("publication-date"),
        F.lit("x").alias("notice-type"),
    )
    df.write.parquet(str(tmp_path / "n"))
    stored = spark.read.parquet(str(tmp_path / "n"))
    found = pages.published_between(stored, "2024-01-01", "2024-01-02", "DE").select(S.col("notice-identifier"))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = found._jdf.queryExecution().explainString(mode)
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(`publication-date`" in pushed and "EqualTo(`organisation-country-buyer`,DE)" in pushed
    assert "notice-type" not in plan


def test_line_breaks_in_quoted_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,v\n1,"two\nlines",5,extra\n2,"a ""b"", c",6\n')
    rows = csvfiles.read_ragged_csv(spark, str(tmp_path)).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "two\nlines", "5", "extra"), ("2", 'a "b", c', "6", "")]
    df = spark.createDataFrame([("1", 'a "b",\nc'), ("2", None)], "id string, text string")
    path = csvfiles.write_csv(df, str(tmp_path / "out"))
    assert sorted(csvfiles.read_csv(spark, path, df.schema).collect()) == sorted(df.collect())


def plain_records(texts):
    """What the csv module reads from whole files."""
    csv.field_size_limit(2**31 - 1)
    return [list(csv.reader(io.StringIO(text, newline=""))) for text in texts]


def padded(records):
    width = max(len(r) for own in records for r in own)
    return Counter(tuple(r + [""] * (width - len(r))) for own in records for r in own[1:])


AWKWARD = [
    "id,text,v\n",
    '1,"a\nb",2\n',
    '"""",x\n',
    'a"b,c"\n',
    '"a"b"c,d\n',
    "\n",
    'x,"","""\n""",y\r\n',
    '"two\r\nlines",1\r\n',
    'q,"a,b\n\n,""c"""\n',
    "one,lone\rreturn\n",
    ',,\n',
    '"\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n",end\n',
    'é,"ü\nß"\n',
]


@pytest.mark.parametrize("split", [16, 64, 1 << 20])
def test_records_that_cross_splits(spark, tmp_path, split):
    draw, texts = random.Random(split), []
    for n in range(4):
        text = AWKWARD[0] + "".join(draw.choice(AWKWARD) for _ in range(60))
        texts.append(text + ('"never closed,\nat all' if n == 3 else ""))
        (tmp_path / f"{n}.csv").write_bytes(text.encode() if n < 3 else texts[-1].encode())
    conf = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        found = csvfiles.read_ragged_csv(spark, str(tmp_path))
        assert Counter(map(tuple, found.collect())) == padded(plain_records(texts))
        assert found.columns[:3] == ["id", "text", "v"]
        firsts = csvfiles.records(spark, str(tmp_path)).filter("is_first").collect()
        assert [r.value for r in firsts] == ["id,text,v"] * 4
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_long_field_in_one_file_of_many_tasks(spark, tmp_path, small_splits):
    """A field of a million characters with line breaks, in a single file that several tasks read."""
    long = "line one\n" * 120_000
    rows = [("1", "a"), ("2", long), ("3", "x" * 200_000)] + [(str(i), f"text {i}") for i in range(4, 20_000)]
    with open(tmp_path / "one.csv", "w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows([("id", "text"), *rows])
    assert csvfiles.records(spark, str(tmp_path)).rdd.getNumPartitions() > 8
    found = csvfiles.read_ragged_csv(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == sorted(rows)
    typed = csvfiles.read_csv(spark, str(tmp_path), "id int, text string")
    assert sorted(map(tuple, typed.collect())) == sorted((int(i), text) for i, text in rows)


def test_inferred_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'n,big,x,flag,day,time,text,none\n1,3000000000,1.5,true,2024-01-02,2024-01-02 03:04:05,a,\n\n-2,4,2,false,2024-02-03,2024-01-02 03:04:06,"1\n2",\n'
    )
    df = csvfiles.read_csv(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "bigint", "double", "boolean", "date", "timestamp", "string", "string"]
    assert sorted((r.n, r.text) for r in df.collect()) == [(-2, "1\n2"), (1, "a")]


def test_ends_quoted_follows_the_csv_module():
    draw = random.Random(1)
    for _ in range(3000):
        line = "".join(draw.choice('"",,ab') for _ in range(draw.randrange(9)))
        for quoted in (False, True):
            # A quoted field left open takes the next line in.
            text = ('"' if quoted else "") + line + "\nnext"
            assert csvfiles.ends_quoted(line, quoted) == (len(list(csv.reader(io.StringIO(text, newline="")))) == 1)


def test_csv_without_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError):
        csvfiles.read_ragged_csv(spark, str(tmp_path))
    with pytest.raises(ValueError):
        csvfiles.read_csv(spark, str(tmp_path))
