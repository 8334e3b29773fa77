"""Boosted trees by second-order steps, with l2 and min_child_weight, from histograms of gradients.

Features are binned at quantile borders. A tree grows level by level: one partial aggregate sums gradients and second derivatives by (node, feature, bin), running sums over
a feature's bins give every split's gain, and one row a node, the best split, comes to the driver. Rows are never exchanged nor
collected: what is exchanged is bounded by nodes x features x bins, whatever the number of rows. A tree is an expression, so scores are columns.

Defined results. Missing values (null, NaN) go to the side on which the gain is larger, left if equal. Of equal gains the feature that is named first and its lowest border win. A node without a
split of positive gain, or whose children would weigh less than min_child_weight, is a leaf of -G / (H + l2), times the step. Rows without a label are left out. The same table gives the same trees,
up to the order in which doubles are added. No rows give trees of one leaf, 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.plans.lineage import saved

#: Gains below this share of the node's own score are rounding.
LEAST_GAIN = 1e-9
#: Trees whose sum is one expression, before the running score is saved.
SAVED_EVERY = 8


@dataclass(frozen=True)
class Node:
    """A leaf (feature None), or a split: values up to `border` go left, missing ones if missing_left."""

    value: float = 0.0
    gain: float = 0.0
    feature: int | None = None
    bin: int = 0
    border: float = 0.0
    missing_left: bool = True


@dataclass(frozen=True)
class Trees:
    """Nodes of each tree by number: the children of k are 2k + 1 and 2k + 2. Scores are base plus the leaves' values."""

    features: list[str]
    base: float
    logistic: bool
    trees: list[dict[int, Node]] = field(default_factory=list)


def borders_of(df: DataFrame, features: list[str], bins: int = 64, accuracy: int = 10_000) -> list[list[float]]:
    """At most bins - 1 quantiles of each feature, from one aggregate of sketches."""
    at = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), at, accuracy).alias(f"c{i}") for i, c in enumerate(features)]).first()
    return [sorted(set(x or [])) for x in row]


def binned(df: DataFrame, features: list[str], borders: list[list[float]]) -> Column:
    """For each feature how many borders lie below the value; null if it is missing."""
    def one(c: str, cuts: list[float]) -> Column:
        x = F.col(c).cast("double")
        bin_ = F.size(F.filter(F.array(*[F.lit(b) for b in cuts]).cast("array<double>"), lambda b: b < x)) if cuts else F.lit(0)
        return F.when(x.isNotNull() & ~F.isnan(x), bin_)

    return F.array(*[one(c, cuts) for c, cuts in zip(features, borders, strict=True)])


def _walk(tree: dict[int, Node], leaf, k: int = 0, depth: int | None = None) -> Column:
    """The tree over the column `bins`: leaf(number, node) where a row ends, after `depth` levels at most."""
    node = tree[k]
    if node.feature is None or depth == 0:
        return leaf(k, node)
    bin_ = F.get("bins", node.feature)
    left = F.when(bin_.isNull(), F.lit(node.missing_left)).otherwise(bin_ <= node.bin)
    return F.when(left, _walk(tree, leaf, 2 * k + 1, depth and depth - 1)).otherwise(_walk(tree, leaf, 2 * k + 2, depth and depth - 1))


def best_splits(histogram: DataFrame, l2: float, min_child_weight: float) -> DataFrame:
    """node, g, h, gain, feature, bin, missing_left of each node: the best split, gain null if there is none. histogram: node, feature, bin (null: missing), g, h."""
    total = lambda g, h: g * g / (h + l2)
    side = Window.partitionBy("node", "feature")
    upto = side.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    known = F.col("bin").isNotNull()
    sums = histogram.withColumns({
        "G": F.sum("g").over(side), "H": F.sum("h").over(side), "mg": F.coalesce(F.sum(F.when(~known, F.col("g"))).over(side), F.lit(0.0)), "mh": F.coalesce(F.sum(F.when(~known, F.col("h"))).over(side), F.lit(0.0)),
        "gl": F.sum(F.when(known, F.col("g")).otherwise(0.0)).over(upto), "hl": F.sum(F.when(known, F.col("h")).otherwise(0.0)).over(upto),
    })

    def gain(extra_g: Column, extra_h: Column) -> Column:
        gl, hl = F.col("gl") + extra_g, F.col("hl") + extra_h
        gr, hr = F.col("G") - gl, F.col("H") - hl
        value = total(gl, hl) + total(gr, hr) - total(F.col("G"), F.col("H"))
        heavy = (hl >= min_child_weight) & (hr >= min_child_weight) & (hl > 0) & (hr > 0)
        return F.when(known & heavy & (value > LEAST_GAIN * (1 + total(F.col("G"), F.col("H")))), value)

    both = sums.withColumns({"with": gain(F.col("mg"), F.col("mh")), "without": gain(F.lit(0.0), F.lit(0.0))})
    left = F.coalesce(F.col("with") >= F.col("without"), F.col("with").isNotNull() | F.col("without").isNull())
    one = both.select("node", "feature", "bin", "G", "H", F.greatest("with", "without").alias("gain"), left.alias("missing_left"))
    # the largest gain; of equal ones the first feature, then the lowest bin
    order = F.struct(F.coalesce("gain", F.lit(-1.0)), -F.col("feature"), -F.coalesce("bin", F.lit(0)))
    picked = F.max_by(F.struct(F.col("G").alias("g"), F.col("H").alias("h"), "gain", "feature", "bin", "missing_left"), order).alias("s")
    return one.groupBy("node").agg(picked).select("node", "s.*")


def histogram(rows: DataFrame, node: Column) -> DataFrame:
    """node, feature, bin, g, h. rows: bins, g, h; rows whose node is null are at a leaf already."""
    each = rows.select(node.alias("node"), "g", "h", F.posexplode("bins").alias("feature", "bin")).filter("node IS NOT NULL")
    return each.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def grown(rows: DataFrame, borders: list[list[float]], depth: int, step: float, l2: float, min_child_weight: float) -> dict[int, Node]:
    """One tree. rows: bins, g, h."""
    tree: dict[int, Node] = {0: Node()}
    for level in range(depth + 1):
        open_ = [k for k in tree if k >= 2**level - 1]
        if not open_:
            break
        at = _walk(tree, lambda k, node, open_=tuple(open_): F.lit(k if k in open_ else None).cast("int"))
        for r in best_splits(histogram(rows, at), l2, min_child_weight).collect():  # 2^level rows at most
            k, value = r["node"], -r["g"] / (r["h"] + l2) * step if r["h"] + l2 else 0.0
            if r["gain"] is None or level == depth:
                tree[k] = Node(value)
                continue
            f, b = r["feature"], r["bin"]
            tree[k] = Node(value, r["gain"], f, b, borders[f][b] if b < len(borders[f]) else float("inf"), r["missing_left"])
            tree |= {2 * k + 1: Node(), 2 * k + 2: Node()}
    return tree


def fit(
    train: DataFrame, features: list[str], label: str, trees: int = 10, depth: int = 6, step: float = 0.1, l2: float = 1.0, min_child_weight: float = 1.0, base_score: float | None = None, logistic: bool = True,
    subsample: float = 1.0, positive_weight: float = 1.0, bins: int = 64, borders: list[list[float]] | None = None, seed: int = 42,
) -> Trees:
    """Boosted trees for a label of 0 and 1 (logistic) or a number. subsample: the share of rows, by hash of the row, that a tree is grown from."""
    if not features:
        raise ValueError("no feature column")
    borders = borders_of(train, features, bins) if borders is None else borders
    base_score = (0.5 if logistic else 0.0) if base_score is None else base_score
    base = log(base_score / (1 - base_score)) if logistic else base_score
    y = F.col(label).cast("double")
    rows = saved(train.filter(F.col(label).isNotNull()).select(binned(train, features, borders).alias("bins"), y.alias("y"), F.lit(base).alias("m"), F.xxhash64(*[F.col(c) for c in features], y).alias("id")))
    model = Trees(features, base, logistic)
    for k in range(trees):
        p = 1 / (1 + F.exp(-F.col("m")))
        weight = F.when(F.col("y") == 1, float(positive_weight)).otherwise(1.0) if logistic else F.lit(1.0)
        own = rows.select("bins", ((p - F.col("y") if logistic else F.col("m") - F.col("y")) * weight).alias("g"), ((p * (1 - p) if logistic else F.lit(1.0)) * weight).alias("h"), "id")
        if subsample < 1:
            own = own.filter(F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k)), F.lit(1 << 20)) < subsample * (1 << 20))
        tree = grown(own, borders, depth, step, l2, min_child_weight)
        model.trees.append(tree)
        rows = rows.withColumn("m", F.col("m") + _walk(tree, lambda _, node: F.lit(node.value)))
        if (k + 1) % SAVED_EVERY == 0 and k + 1 < trees:
            rows = saved(rows)
    return model


def margins(model: Trees) -> Column:
    """The sum of the leaves that a row falls to, over the features' own values."""

    def one(tree: dict[int, Node], k: int = 0) -> Column:
        node = tree[k]
        if node.feature is None:
            return F.lit(node.value)
        x = F.col(model.features[node.feature]).cast("double")
        left = F.when(x.isNull() | F.isnan(x), F.lit(node.missing_left)).otherwise(x <= node.border)
        return F.when(left, one(tree, 2 * k + 1)).otherwise(one(tree, 2 * k + 2))

    out = F.lit(model.base)
    for tree in model.trees:
        out = out + one(tree)
    return out


def score_table(model: Trees, df: DataFrame, key: str, label: str) -> DataFrame:
    """id, label, score: the probability of class 1, or the number."""
    m = margins(model)
    return df.select(F.col(key).alias("id"), F.col(label).alias("label"), (1 / (1 + F.exp(-m)) if model.logistic else m).alias("score"))


def table(model: Trees) -> list[tuple]:
    """(tree, node, feature, border, gain, value, missing_left) of every node."""
    return [(t, k, None if n.feature is None else model.features[n.feature], n.border if n.feature is not None else None, n.gain, n.value, n.missing_left) for t, tree in enumerate(model.trees) for k, n in sorted(tree.items())]
