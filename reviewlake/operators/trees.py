"""Fitted trees as a table of nodes, and scoring by walking it.

``node_table`` reads what ``save_model`` wrote: one row per node of every tree,
(model, tree, node, left, right, feature, threshold, value, gain, weight,
tree_weight). Its size is bounded by the model (trees * 2^(depth + 1) rows),
never by the data. ``walk`` scores documents inside their rows: the table, as
one constant, is followed level by level with array functions, so scoring a
table of any size needs neither a join nor a shuffle. ``importance`` sums the
impurity gains.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.sinks.tables import _fs

# a leaf's children and feature
LEAF = -1


def _stage(spark: SparkSession, model_path: str) -> tuple[str, str]:
    """(folder, class name) of a saved pipeline's last stage."""
    fs, p, jvm = _fs(spark, f"{model_path.rstrip('/')}/stages")
    last = max((st.getPath() for st in fs.listStatus(p)), key=lambda q: int(q.getName().split("_")[0]))
    meta = json.loads(spark.read.text(f"{last.toString()}/metadata").first()[0])
    return last.toString(), meta["class"].rsplit(".", 1)[1]


def is_tree_model(spark: SparkSession, model_path: str) -> bool:
    return any(k in _stage(spark, model_path)[1] for k in ("DecisionTree", "RandomForest", "GBT"))


def node_table(spark: SparkSession, model_path: str, model_name: str = "model") -> DataFrame:
    """(model, tree, node, left, right, feature, threshold, value, gain, weight, tree_weight).

    ``value`` holds class weights for classification trees, the predicted
    number for the regression trees of a boosted model. Leaves have children
    and feature -1. ``weight`` is the weight of the training rows at the node.
    """
    folder, kind = _stage(spark, model_path)
    data = spark.read.parquet(f"{folder}/data")
    if "nodeData" in data.columns:
        # named by position in newer versions
        weights = spark.read.parquet(f"{folder}/treesMetadata").toDF("treeID", "metadata", "tree_weight").drop("metadata")
        nodes = data.join(F.broadcast(weights), "treeID").select("treeID", "nodeData.*", "tree_weight")
    else:
        nodes = data.select(F.lit(0).alias("treeID"), "*", F.lit(1.0).alias("tree_weight"))
    boosted = kind.startswith("GBT")
    stats = F.col("impurityStats")
    leaf = F.col("leftChild") < 0
    return nodes.select(
        F.lit(model_name).alias("model"), F.col("treeID").cast("int").alias("tree"), F.col("id").alias("node"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.when(leaf, F.lit(LEAF)).otherwise(F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        (F.array("prediction") if boosted else stats).alias("value"),
        F.col("gain"),
        # a variance summary starts with its count; class counts add up to it
        (F.get(stats, F.lit(0)) if boosted else F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)).alias("weight"),
        F.col("tree_weight").cast("double").alias("tree_weight"))


def _constant(nodes: DataFrame) -> Column:
    """The whole table as one constant: an array of trees, each an array of its nodes by number."""
    kind = ("array<struct<tree_weight:double,nodes:array<struct<left:int,right:int,feature:int,"
            "threshold:double,value:array<double>>>>>")
    trees: dict[int, tuple[float, list]] = {}
    for r in nodes.orderBy("tree", "node").collect():           # bounded by the model, not by the data
        made = trees.setdefault(r["tree"], (r["tree_weight"], []))[1]
        if r["node"] != len(made):
            raise ValueError(f"tree {r['tree']} lacks node {len(made)}")
        made.append({"left": r["left"], "right": r["right"], "feature": r["feature"],
                     "threshold": r["threshold"], "value": r["value"]})
    return F.from_json(F.lit(json.dumps([{"tree_weight": w, "nodes": n} for w, n in trees.values()])), kind)


def walk(nodes: DataFrame, features: Column, depth: int = 30, boosted: bool = False) -> Column:
    """struct(prediction, probability) of the rows' sparse ``features``, by the trees in ``nodes``.

    ``features`` is a map of index to value; an index it lacks is 0. Each tree
    is followed from node 0 for at most ``depth`` levels (MLlib's limit). Class
    trees vote with their leaf's class shares; boosted trees add their numbers,
    and the margin m becomes 1 / (1 + exp(-2m)). The first class wins ties.
    """
    def leaf_of(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree["nodes"], at)
            value = F.coalesce(F.element_at(features, node["feature"]), F.lit(0.0))
            return F.when(node["feature"] < 0, at).when(value <= node["threshold"], node["left"]).otherwise(node["right"])
        return F.get(tree["nodes"], F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step))

    trees = _constant(nodes)
    if boosted:
        margin = F.aggregate(trees, F.lit(0.0), lambda s, t: s + t["tree_weight"] * F.get(leaf_of(t)["value"], F.lit(0)))
        p = 1 / (1 + F.exp(-2 * margin))
        return F.struct(F.when(margin > 0, 1.0).otherwise(0.0).alias("prediction"), p.alias("probability"))

    def share(leaf: Column) -> Column:
        return F.get(leaf["value"], F.lit(1)) / F.aggregate(leaf["value"], F.lit(0.0), lambda a, x: a + x)
    p = F.aggregate(trees, F.lit(0.0), lambda s, t: s + share(leaf_of(t))) / F.size(trees)
    return F.struct(F.when(p > 0.5, 1.0).otherwise(0.0).alias("prediction"), p.alias("probability"))


def max_depth(nodes: DataFrame) -> int:
    """Levels below the deepest tree's root, from the bounded node table."""
    kids: dict[tuple[int, int], tuple[int, int]] = {
        (r["tree"], r["node"]): (r["left"], r["right"]) for r in nodes.select("tree", "node", "left", "right").collect()}
    level, depth = {k for k in kids if k[1] == 0}, 0
    while level := {(t, c) for t, n in level for c in kids[t, n] if c >= 0}:
        depth += 1
    return depth


def walk_scores(nodes: DataFrame, featurised: DataFrame, keep: tuple[str, ...] = ("event_id", "label"),
                features_col: str = "features", boosted: bool = False) -> DataFrame:
    """(*keep, prediction, probability): ``walk`` over MLlib's sparse feature vectors."""
    v = F.unwrap_udt(features_col)
    # a dense vector has no indices: its places are 0, 1, ...
    index = F.coalesce(v["indices"], F.transform(v["values"], lambda _, i: i))
    rows = featurised.select(*keep, F.map_from_arrays(index, v["values"]).alias("__f"))
    return (rows.withColumn("__s", walk(nodes, F.col("__f"), max(1, max_depth(nodes)), boosted))
            .select(*keep, "__s.prediction", "__s.probability"))


def importance(nodes: DataFrame, per_tree: bool = True) -> DataFrame:
    """(feature, importance): impurity gains times row weight, summed by feature; they add up to 1.

    ``per_tree`` first scales every tree to 1, as MLlib does for trees and
    forests but not for boosted ones. Aggregates over the bounded node table.
    """
    gains = (nodes.where(F.col("feature") >= 0).groupBy("tree", "feature")
             .agg(F.sum(F.col("gain") * F.col("weight")).alias("g")))
    if per_tree:
        of_tree = gains.groupBy("tree").agg(F.sum("g").alias("of_tree"))
        gains = gains.join(of_tree, "tree").select("tree", "feature", F.try_divide("g", "of_tree").alias("g"))
    by_feature = gains.groupBy("feature").agg(F.sum("g").alias("g"))
    total = by_feature.agg(F.sum("g")).scalar()
    return by_feature.select("feature", F.try_divide("g", total).alias("importance"))
