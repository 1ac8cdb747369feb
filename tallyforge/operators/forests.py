"""A fitted forest as a table of nodes, and prediction by joins with that table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import scratch_path


def forest_table(spark: SparkSession, model: Model) -> DataFrame:
    """``tree, node, feature, threshold, left, right, votes`` of every node of a fitted classification forest.

    Inner nodes have the number of a feature, and rows go ``left`` where it is at most ``threshold``. Leaves have null
    there and in ``votes`` the share of each class among their training rows. Node 0 of a tree is its root. Read back
    from the model as it is stored; splits by category are refused.
    """
    path = scratch_path(spark, "forest")
    model.save(path)
    stored = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    if stored.filter("split.numCategories >= 0").limit(1).count():
        raise ValueError("the forest splits by category; only numeric features can be walked")
    leaf = F.col("leftChild") < 0
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return stored.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(~leaf, F.col("leftChild")).alias("left"),
        F.when(~leaf, F.col("rightChild")).alias("right"),
        F.when(leaf, F.transform("impurityStats", lambda x: F.coalesce(F.try_divide(x, total), F.lit(0.0)))).alias("votes"),
    )


def walk(df: DataFrame, forest: DataFrame, key: str, features: Sequence[str], depth: int) -> DataFrame:
    """``key, votes, prediction``: every row sent through all trees, level by level.

    Each row stands at the root of every tree and is joined with the nodes once for each level down to ``depth``, the
    greatest depth the forest was fitted with. The nodes, trees times ``2 ** (depth + 1)`` rows at most, are sent to
    all tasks, so only one row for each key and task is shuffled: the votes added up in the order of the trees. The
    prediction is the class with most votes, of equal ones the first. Rows with a null feature are dropped, as
    assembling does with ``skip``; keys must be unique, and the null key is one.
    """
    nodes = forest.select(
        F.col("tree").alias("_tree"), F.col("node").alias("_node"), F.struct("feature", "threshold", "left", "right", "votes").alias("_here")
    )
    rows = df.select(F.col(key), F.array(*[F.col(f).cast("double") for f in features]).alias("_x")).filter(~F.exists("_x", lambda x: x.isNull()))
    # Broadcast: the bound is in the docstring.
    at = rows.join(F.broadcast(nodes.filter("_node = 0")))
    for _ in range(depth):
        value = F.element_at("_x", F.col("_here.feature") + 1)
        inner = F.col("_here.votes").isNull()
        child = F.when(inner, F.when(value <= F.col("_here.threshold"), F.col("_here.left")).otherwise(F.col("_here.right"))).otherwise(F.col("_node"))
        at = at.select(key, "_x", "_tree", child.alias("_node")).join(F.broadcast(nodes), ["_tree", "_node"])
    votes = at.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_tree", F.col("_here.votes").alias("votes")))).alias("votes"))
    first = F.col("votes")[0]["votes"]
    added = F.aggregate(
        F.slice("votes", 2, F.greatest(F.size("votes") - 1, F.lit(0))), first, lambda total, tree: F.zip_with(total, tree["votes"], lambda a, b: a + b)
    )
    summed = votes.select(key, added.alias("votes"))
    return summed.withColumn("prediction", (F.array_position("votes", F.array_max("votes")) - 1).cast("double"))
