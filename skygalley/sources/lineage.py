"""Catalog and lineage tables from a model manifest, a JSON document with one entry per node."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT = T.StringType()
MANIFEST = T.StructType(
    [
        T.StructField(
            "nodes",
            T.MapType(
                _TEXT,
                T.StructType(
                    [
                        T.StructField("resource_type", _TEXT),
                        T.StructField("unique_id", _TEXT),
                        T.StructField("name", _TEXT),
                        T.StructField("schema", _TEXT),
                        T.StructField("original_file_path", _TEXT),
                        T.StructField("path", _TEXT),
                        T.StructField("description", _TEXT),
                        T.StructField("tags", T.ArrayType(_TEXT)),
                        T.StructField(
                            "config", T.StructType([T.StructField("materialized", _TEXT)])
                        ),
                        T.StructField(
                            "depends_on", T.StructType([T.StructField("nodes", T.ArrayType(_TEXT))])
                        ),
                    ]
                ),
            ),
        )
    ]
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per model node of the manifest."""
    document = spark.read.schema(MANIFEST).json(path, multiLine=True)
    nodes = document.select(F.explode("nodes").alias("node_id", "node"))
    return nodes.where(F.col("node.resource_type") == "model")


def models(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        "node.unique_id",
        "node.name",
        F.col("node.schema").alias("schema_name"),
        F.split("node.original_file_path", "/")[1].alias("layer"),
        F.col("node.config.materialized").alias("materialization"),
        "node.description",
        "node.path",
        "node.tags",
    )


def dependencies(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        F.explode("node.depends_on.nodes").alias("from_node"), F.col("node_id").alias("to_node")
    )
