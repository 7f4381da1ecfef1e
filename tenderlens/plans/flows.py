"""End-to-end flows: ingest, train, detect, cluster, evaluate, report."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenderlens.functions import scalars as S
from tenderlens.functions.quantiles import sample_rows
from tenderlens.operators import cleaning, dbscan, features, forest, kmeans, neighbours, quality, runs, summaries
from tenderlens.operators.features import FeatureState
from tenderlens.session import identified, materialise
from tenderlens.sources import csvfiles, models, pages


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def _name(prefix: str, stamp: str) -> str:
    digits = "".join(ch for ch in stamp if ch.isdigit())
    return f"{prefix}_{digits[:8]}_{digits[8:14]}"


def ingest(
    spark: SparkSession,
    pages_path: str,
    output: str,
    days_back: int = 30,
    max_value: float | None = None,
    country: str | None = None,
    as_of: str | None = None,
    page_per_line: bool = False,
) -> dict:
    """Landed pages to raw, normalised and learning CSV folders; returns their paths and the learning table."""
    stamp = as_of or _now()
    raw = pages.flatten(pages.read_pages(spark, pages_path, page_per_line=page_per_line))
    if "publication-date" in raw.columns:
        raw = pages.looking_back(raw.withColumn("publication-date", S.col("publication-date").cast("timestamp")), days_back, stamp)
    if country:
        raw = raw.filter(S.col("organisation-country-buyer") == country)
    if max_value is not None and "total-value" in raw.columns:
        raw = pages.within_budget(raw, max_value)
    raw = materialise(pages.requested(raw), "raw")
    normalised = materialise(cleaning.normalise(raw), "normalised")
    learning = cleaning.prepare_for_ml(normalised)
    return {
        "raw": csvfiles.write_csv(raw, f"{output}/{_name('notices', stamp)}"),
        "normalized": csvfiles.write_csv(normalised, f"{output}/{_name('normalized', stamp)}"),
        "ml_dataset": csvfiles.write_csv(learning, f"{output}/{_name('ml_dataset', stamp)}"),
        "ml_df": learning,
    }


def fit_features(df: DataFrame, key: str, numeric_only: bool = False, whole_word: bool = False) -> FeatureState:
    numeric, categorical = features.model_features(df, whole_word)
    chosen = [c for c in numeric if c != key], [] if numeric_only else [c for c in categorical if c != key]
    return features.fit(df, *chosen)


def train_forest(
    df: DataFrame,
    key: str,
    path: str,
    contamination: float = 0.05,
    sample_size: int | None = None,
    numeric_only: bool = False,
    as_of: str | None = None,
) -> str:
    """Train on ``df`` and save; returns the model folder."""
    state = fit_features(df, key, numeric_only)
    trained = forest.train(df, key, state, contamination, sample_size)
    return models.save_forest(df.sparkSession, path, state, trained, as_of or _now())


def detect_with_forest(
    df: DataFrame,
    key: str,
    model_path: str,
    store: runs.RunStore | None = None,
    training: DataFrame | None = None,
    csv_path: str | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Score with the saved model, training it first if it is absent; write CSV and store the run if asked."""
    spark = df.sparkSession
    if training is not None and not models.exists(spark, model_path):
        train_forest(training, key, model_path, as_of=as_of)
    state, trained = models.load_forest(spark, model_path)
    scored = materialise(forest.predict(df, state, trained, as_of), "scored")
    if csv_path:
        csvfiles.write_csv(scored, csv_path)
    if store:
        parameters = {"contamination": trained.contamination}
        store.store("isolation_forest", scored, parameters, executed_at=as_of)
    return scored


def _density(matrix: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """Cluster and neighbour score of every row of an identified matrix, whatever its key."""
    labels = dbscan.dbscan(matrix, "_identity", eps, min_samples)
    scores = neighbours.knn_scores(matrix, "_identity", min_samples).select("_identity", "anomaly_score")
    return matrix.join(labels, "_identity").join(scores, "_identity").drop("_identity")


def cluster_run(
    df: DataFrame,
    key: str,
    method: str = "dbscan",
    eps: float = 0.5,
    min_samples: int = 5,
    n_clusters: int = 5,
    constant_distance: bool = False,
    csv_path: str | None = None,
    store: runs.RunStore | None = None,
) -> DataFrame:
    """Cluster a table on its zero-filled, standardised numbers and flag its outliers.

    DBSCAN: noise is outlier and scores 1, other rows their mean neighbour distance over
    the highest. KMeans: rows far from their centroid are outliers.
    """
    numeric = [c for c in features.cluster_features(df) if c != key]
    state = features.fit_zero_filled(df, numeric)
    if method == "dbscan":
        matrix = identified(features.with_features(df, state), key)
        found = dbscan.noise_override(dbscan.flag_noise(_density(matrix, eps, min_samples)))
    elif method == "kmeans":
        matrix = materialise(features.with_features(df, state), "matrix")
        found = kmeans.detect(matrix, kmeans.fit(matrix, key, n_clusters), constant_distance)
    else:
        raise ValueError(f"unknown clustering method {method!r}")
    found = materialise(found.drop("features"), "found")
    if csv_path:
        csvfiles.write_csv(found, csv_path)
    if store:
        used = {"eps": eps, "min_samples": min_samples} if method == "dbscan" else {"n_clusters": n_clusters}
        store.store(method, found, used)
    return found


def train_clustering(
    df: DataFrame,
    key: str,
    path: str,
    method: str = "dbscan",
    eps: float | None = 0.5,
    min_samples: int = 5,
    n_clusters: int = 5,
    as_of: str | None = None,
    sample_size: int | None = None,
    numeric_only: bool = False,
) -> str:
    """Fit the feature pipeline and the clustering and save both; a missing eps is taken from the elbow.

    With ``sample_size`` both learn from exactly so many rows.
    """
    if sample_size:
        df = materialise(sample_rows(df, F.col(f"`{key}`"), sample_size), "sample")
    state = fit_features(df, key, numeric_only)
    matrix = materialise(features.with_features(df, state), "matrix")
    trained = None
    if method == "kmeans":
        trained = kmeans.fit(matrix, key, n_clusters)
    elif eps is None or eps <= 0:
        eps = neighbours.elbow_eps(matrix, key, min_samples).first()["eps"]
    return models.save_clustering(
        df.sparkSession, path, state, method, as_of or _now(), trained, eps, min_samples
    )


def detect_with_clustering(
    df: DataFrame, key: str, model_path: str, as_of: str | None = None, constant_distance: bool = False
) -> DataFrame:
    """Annotate with a saved clustering. Saved centroids are applied; density clusters are found anew."""
    model = models.load_clustering(df.sparkSession, model_path)
    matrix = identified(features.with_features(df, model["features"]), key)
    if model["method"] == "kmeans":
        found = kmeans.detect(matrix.drop("_identity"), model["kmeans"], constant_distance).drop("distance")
    else:
        found = dbscan.flag_noise(_density(matrix, model["eps"], model["min_samples"]))
    return forest.annotate(found, F.col("anomaly_score"), F.col("is_outlier"), as_of).drop("features")


def evaluate_clustering(df: DataFrame, key: str, model_path: str) -> DataFrame:
    model = models.load_clustering(df.sparkSession, model_path)
    matrix = materialise(features.with_features(df, model["features"]), "matrix")
    if model["method"] == "kmeans":
        return quality.kmeans_record(matrix, model["kmeans"])
    return quality.dbscan_record(matrix, key, model["eps"], model["min_samples"])


def evaluate_forest(df: DataFrame, model_path: str, output: str | None = None, as_of: str | None = None) -> DataFrame:
    """The metrics row of a saved forest on ``df``, also written as JSON if asked."""
    state, trained = models.load_forest(df.sparkSession, model_path)
    metrics = summaries.evaluation(forest.predict(df, state, trained, as_of), as_of)
    if output:
        csvfiles.write_json(metrics, output)
    return metrics


def write_report(
    store: runs.RunStore,
    output: str,
    df: DataFrame | None = None,
    days: int = 30,
    as_of: str | None = None,
    model_path: str | None = None,
) -> DataFrame:
    """The report row of ``df``, or of all rows stored in the last ``days`` days, written as JSON.

    A table without flags is scored first where a saved forest is named.
    """
    today = as_of or _now()
    if df is None:
        window = store.spark.sql(f"select date_sub(date'{today[:10]}', {int(days)}) as start").first()
        df = runs.results_between(store.rows, store.runs, str(window.start), today[:10])
        if df.isEmpty():
            raise ValueError(f"no stored rows in the last {days} days")
    elif model_path and "is_outlier" not in df.columns:
        state, trained = models.load_forest(df.sparkSession, model_path)
        df = materialise(forest.predict(df, state, trained, as_of), "scored")
    row = summaries.report(df, runs.overall_statistics(store.rows, store.runs), days, as_of)
    csvfiles.write_json(row, output)
    return row
