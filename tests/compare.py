"""Run registered queries against their SQL in DuckDB: ``python tests/compare.py FOLDER [NAME ...]``."""

import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def open_database(folder):
    database = duckdb.connect()
    for name in TABLES:
        database.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return database


def _kind(text):
    text = text.lower()
    for kind, names in {
        "int": ("tinyint", "smallint", "int", "bigint", "hugeint"),
        "float": ("float", "double", "decimal"),
        "text": ("string", "varchar"),
        "bool": ("boolean",),
    }.items():
        if text.startswith(names):
            return kind
    return text


def _order(row):
    return tuple((value is not None, str(type(value)), value if value is not None else 0) for value in row)


def compare(spark, database, name, folder):
    """A list of differences, empty when both sides agree."""
    df = entry.queries()[name](spark, folder)
    columns = sorted(df.columns)
    mine = [tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect()]
    sql = entry.oracle_sql()[name]
    relation = database.sql(sql)
    if sorted(relation.columns) != columns:
        return [f"columns {columns} against {sorted(relation.columns)}"]
    problems = []
    kinds = dict(zip(relation.columns, relation.types))
    for field in df.schema:
        theirs = str(kinds[field.name])
        if _kind(field.dataType.simpleString()) != _kind(theirs):
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} against {theirs}")
        elif field.dataType.simpleString() in ("int", "bigint") and theirs.lower() not in ("integer", "bigint"):
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} against {theirs}")
    order = [relation.columns.index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in database.execute(sql).fetchall()]
    if len(mine) != len(expected):
        problems.append(f"{len(mine)} rows against {len(expected)}")
    else:
        pairs = list(zip(sorted(mine, key=_order), sorted(expected, key=_order)))
        different = [pair for pair in pairs if pair[0] != pair[1]]
        if different:
            problems.append(f"{len(different)} of {len(pairs)} rows differ, first: {different[0]}")
    return problems


if __name__ == "__main__":
    from tenderlens.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare",
        master=f"local[{os.environ.get('CPUS', '8')}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    database = open_database(folder)
    failed = 0
    for name in names or entry.queries():
        start = time.time()
        try:
            if name in entry.oracle_sql():
                problems = compare(spark, database, name, folder)
            else:
                rows = entry.queries()[name](spark, folder).collect()
                problems = [] if rows else ["no rows"]
                name += " (rows only)"
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s {'; '.join(problems)}", flush=True)
    print(f"{failed} failed")
