"""Saved models: one folder per version with a JSON document, the categories of text features and, for a forest, the node table."""

import json

from pyspark.sql import SparkSession

from tenderlens.operators.features import CATEGORIES, FeatureState
from tenderlens.operators.forest import NODE_SCHEMA, ForestState
from tenderlens.operators.kmeans import KMeansState


def save_document(spark: SparkSession, path: str, document: dict) -> None:
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.text(f"{path}/model")


def load_document(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/model").first()["value"])


def exists(spark: SparkSession, path: str) -> bool:
    document = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/model/_SUCCESS")
    return document.getFileSystem(spark._jsc.hadoopConfiguration()).exists(document)


def _save_features(spark: SparkSession, path: str, features: FeatureState) -> dict:
    """The categories go to the model's folder; returns what the document holds."""
    if features.categories:
        table = spark.read.schema(CATEGORIES).parquet(features.categories)
        table.write.partitionBy("feature").parquet(f"{path}/categories")
    return features.to_dict()


def _load_features(path: str, data: dict) -> FeatureState:
    """Categories lie beside the document, wherever the folder is now."""
    return FeatureState.from_dict({**data, "categories": f"{path}/categories" if data["categories"] else None})


def save_forest(spark: SparkSession, path: str, features: FeatureState, state: ForestState, trained_at: str) -> str:
    """Write the model and return its folder; the node table goes first, so a model with a document is whole."""
    spark.createDataFrame(state.nodes, NODE_SCHEMA).coalesce(1).write.parquet(f"{path}/nodes")
    document = {"features": _save_features(spark, path, features), "forest": state.to_dict(), "trained_at": trained_at}
    save_document(spark, path, document)
    return path


def load_forest(spark: SparkSession, path: str) -> tuple[FeatureState, ForestState]:
    document = load_document(spark, path)
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
    return _load_features(path, document["features"]), ForestState(nodes=nodes, **document["forest"])


def save_clustering(
    spark: SparkSession,
    path: str,
    features: FeatureState,
    method: str,
    trained_at: str,
    kmeans: KMeansState | None = None,
    eps: float | None = None,
    min_samples: int | None = None,
) -> str:
    document = {
        "features": _save_features(spark, path, features),
        "method": method,
        "kmeans": kmeans.to_dict() if kmeans else None,
        "eps": eps,
        "min_samples": min_samples,
        "trained_at": trained_at,
    }
    save_document(spark, path, document)
    return path


def load_clustering(spark: SparkSession, path: str) -> dict:
    document = load_document(spark, path)
    document["features"] = _load_features(path, document["features"])
    if document["kmeans"]:
        document["kmeans"] = KMeansState(**document["kmeans"])
    return document
