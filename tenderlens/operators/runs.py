"""Stored runs: result rows, run metadata, and the queries over both.

Result rows live in a Parquet table with a folder per ``run_id``; metadata in a second
table. A run is written to a staging folder of its own. Its rows are then moved to their place,
and one rename of its metadata publishes it: readers join the rows to the metadata. A store that broke
off anywhere leaves nothing that is read, and the next one under the same id starts afresh.
"""

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tenderlens.functions import scalars as S
from tenderlens.schema import (
    COUNTRY_NAMES,
    ID_NAMES,
    RESULT_SCHEMA,
    RUN_SCHEMA,
    STORED_VALUE_NAMES,
    TYPE_NAMES,
)
from tenderlens.sources.csvfiles import write_csv


def result_rows(df: DataFrame, run_id: Column) -> DataFrame:
    """Scored rows in the stored shape."""
    flag = F.coalesce(F.col("is_outlier").cast("int"), F.lit(0)) if "is_outlier" in df.columns else F.lit(0)
    score = F.col("anomaly_score").cast("double") if "anomaly_score" in df.columns else F.lit(0.0)
    return df.select(
        run_id.alias("run_id"),
        S.text_or_unknown(df.columns, ID_NAMES).alias("notice_id"),
        S.number_or_zero(df.columns, STORED_VALUE_NAMES).alias("value_eur"),
        S.text_or_unknown(df.columns, COUNTRY_NAMES).alias("country"),
        S.text_or_unknown(df.columns, TYPE_NAMES).alias("notice_type"),
        flag.alias("is_outlier"),
        F.coalesce(score, F.lit(0.0)).alias("anomaly_score"),
    )


class RunStore:
    """The two tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.rows_path, self.runs_path = f"{root}/procurement_results", f"{root}/model_runs"
        self.staging_path = f"{root}/_staging"

    def _files(self):
        """Hadoop's path class and the file system of the store."""
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        return Path, Path(self.rows_path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folder(self, table: str, run_id: str):
        """The folder of a run in a table, named as Spark names partitions."""
        escaped = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run_id)
        return self._files()[0](f"{table}/run_id={escaped}")

    def _read(self, path: str, schema: str) -> DataFrame:
        Path, system = self._files()
        if not system.exists(Path(path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    @property
    def runs(self) -> DataFrame:
        return self._read(self.runs_path, RUN_SCHEMA)

    @property
    def rows(self) -> DataFrame:
        """Rows of complete runs."""
        return self._read(self.rows_path, RESULT_SCHEMA).join(self.runs.select("run_id"), "run_id", "left_semi")

    def store(self, model_type, df, parameters=None, notes=None, executed_at=None, run_id=None) -> str:
        """Store one run and return its id.

        A run that is stored already stays as it is, so a call may be repeated under its id. One id
        is written by one caller at a time.
        """
        run_id = run_id or str(uuid.uuid4())
        Path, system = self._files()
        if system.exists(self._folder(self.runs_path, run_id)):
            return run_id
        staged = self._folder(self.staging_path, run_id)
        system.delete(staged, True)
        rows, metadata = f"{staged}/rows", f"{staged}/run"
        result_rows(df, F.lit(run_id)).drop("run_id").write.parquet(rows)
        written = self.spark.read.schema(RESULT_SCHEMA).parquet(rows)
        found = written.agg(
            F.count("*").alias("record_count"),
            F.coalesce(F.sum(F.col("is_outlier").cast("bigint")), F.lit(0)).alias("outlier_count"),
        ).select(
            F.lit(model_type).alias("model_type"),
            F.lit(json.dumps(parameters) if parameters else None).cast("string").alias("parameters"),
            S.stamp(executed_at).alias("execution_date"),
            "record_count",
            "outlier_count",
            S.percent(F.col("outlier_count"), F.col("record_count")).alias("outlier_percentage"),
            F.lit(notes).cast("string").alias("notes"),
        )
        found.coalesce(1).write.parquet(metadata)
        for source, table in ((rows, self.rows_path), (metadata, self.runs_path)):
            self._move(system, Path(source), self._folder(table, run_id))
        system.delete(staged, True)
        return run_id

    def _move(self, system, source, target) -> None:
        """Put a folder in its place; rows that an unpublished store left there go."""
        system.delete(target, True)
        system.mkdirs(target.getParent())
        if not system.rename(source, target):
            raise OSError(f"cannot move {source} to {target}")

    def export_csv(self, run_id: str, path: str) -> bool:
        """Write the rows of one run as CSV; False, and no files, for an empty run."""
        rows = run_rows(self.rows, run_id)
        if rows.isEmpty():
            return False
        write_csv(rows, path)
        return True

    def remove_old(self, days_to_keep: int = 30, as_of: str | None = None) -> int:
        """Delete runs from before the cutoff day and return how many there were.

        Both tables have a folder per run. A run's metadata goes first, so it stops being
        visible before its rows go, and nothing is ever rewritten: a crash between two
        deletes leaves whole runs, and the next call goes on.
        """
        expired = expired_runs(self.runs, days_to_keep, as_of).select("run_id")
        _, system = self._files()
        gone = 0
        for row in expired.toLocalIterator():
            for table in (self.runs_path, self.rows_path):
                self._drop(system, self._folder(table, row.run_id))
            gone += 1
        return gone

    def _drop(self, system, folder) -> None:
        system.delete(folder, True)


def run_rows(rows: DataFrame, run_id: str) -> DataFrame:
    return rows.filter(F.col("run_id") == run_id)


def top_outliers(rows: DataFrame, run_id: str, limit: int = 100, ascending: bool = False) -> DataFrame:
    """Flagged rows of a run, highest score first; ``ascending`` suits models whose low scores are worst."""
    order = F.asc("anomaly_score") if ascending else F.desc("anomaly_score")
    flagged = run_rows(rows, run_id).filter(F.col("is_outlier") == 1)
    return flagged.orderBy(order, "notice_id").limit(limit)


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    shown = runs.select(
        "run_id", "model_type", "execution_date", "record_count", "outlier_count", "outlier_percentage", "notes"
    )
    return shown.orderBy(F.desc("execution_date"), "run_id").limit(limit)


def results_between(rows: DataFrame, runs: DataFrame, start: str, end: str, limit: int | None = None) -> DataFrame:
    """Rows of runs executed from day ``start`` to day ``end``, newest run first; all of them unless ``limit`` is given."""
    day = F.substring("execution_date", 1, 10)
    chosen = runs.filter(day.between(start, end)).select("run_id", "execution_date")
    joined = rows.join(chosen, "run_id")
    ordered = joined.orderBy(F.desc("execution_date"), "run_id", "notice_id")
    return ordered if limit is None else ordered.limit(limit)


def rows_with_runs(rows: DataFrame, runs: DataFrame) -> DataFrame:
    return rows.join(runs.select("run_id", "model_type", "execution_date"), "run_id")


def _cutoff(days_to_keep: int, as_of: str | None) -> Column:
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    return F.date_format(F.date_sub(today, days_to_keep), "yyyy-MM-dd")


def expired_runs(runs: DataFrame, days_to_keep: int = 30, as_of: str | None = None) -> DataFrame:
    """Runs whose execution text sorts before the cutoff day; runs on that day stay."""
    return runs.filter(F.col("execution_date") < _cutoff(days_to_keep, as_of))


def retained(table: DataFrame, runs: DataFrame, days_to_keep: int = 30, as_of: str | None = None) -> DataFrame:
    return table.join(expired_runs(runs, days_to_keep, as_of).select("run_id"), "run_id", "left_anti")


def outlier_statistics(rows: DataFrame, run_id: str) -> DataFrame:
    flagged = run_rows(rows, run_id).filter(F.col("is_outlier") == 1)
    return flagged.agg(
        F.count("*").alias("total_outliers"),
        F.avg("anomaly_score").alias("avg_score"),
        F.min("value_eur").alias("min_value"),
        F.max("value_eur").alias("max_value"),
        F.avg("value_eur").alias("avg_value"),
    )


def country_breakdown(rows: DataFrame, run_id: str, limit: int = 10) -> DataFrame:
    grouped = run_rows(rows, run_id).groupBy("country").agg(
        F.count("*").alias("total"),
        F.sum(F.col("is_outlier").cast("bigint")).alias("outliers"),
        F.round(F.avg("is_outlier") * 100, 2).alias("outlier_pct"),
    )
    return grouped.orderBy(F.desc("total"), "country").limit(limit)


def run_summary(rows: DataFrame, runs: DataFrame, run_id: str) -> DataFrame:
    """One row: metadata, outlier statistics and the country breakdown; no row for an unknown run."""
    info = runs.filter(F.col("run_id") == run_id).withColumn(
        "parameter_map", S.parameters_map(F.col("parameters"))
    )
    stats = outlier_statistics(rows, run_id).select(F.struct("*").alias("outlier_stats"))
    # At most ten countries are gathered.
    ordered = F.struct((-F.col("total")).alias("rank"), "country", "total", "outliers", "outlier_pct")
    countries = country_breakdown(rows, run_id).agg(F.sort_array(F.collect_list(ordered)).alias("ranked"))
    countries = countries.select(F.transform("ranked", lambda c: c.dropFields("rank")).alias("country_breakdown"))
    return info.crossJoin(F.broadcast(stats)).crossJoin(F.broadcast(countries))


def overall_statistics(rows: DataFrame, runs: DataFrame) -> DataFrame:
    by_rows = rows.agg(
        F.count("*").alias("total_records"), F.count_if(F.col("is_outlier") == 1).alias("total_outliers")
    )
    by_runs = runs.agg(
        F.count("*").alias("total_runs"),
        F.min("execution_date").alias("first_run"),
        F.max("execution_date").alias("last_run"),
    )
    share = S.percent(F.col("total_outliers"), F.col("total_records"))
    return by_runs.crossJoin(F.broadcast(by_rows)).withColumn("overall_outlier_percentage", share)


def runs_per_model(runs: DataFrame) -> DataFrame:
    return runs.groupBy("model_type").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "model_type")
