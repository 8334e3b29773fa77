"""Evaluation metrics as aggregates over a table of predictions (id, label, score), or (id, label, scores)."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tributary.operators.rank import PART, by_range, running_sums
from tributary.plans.lineage import new_folder, saved

#: Classes of which a full grid of pairs is made.
MAX_GRID = 1000


def predict_label(score: Column, threshold: float = 0.5) -> Column:
    return F.when(score > threshold, 1).otherwise(0)


def predict_class(scores: Column) -> Column:
    """The place of the largest score, the lowest on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def accuracy(df: DataFrame) -> DataFrame:
    """df (label, pred)."""
    return df.agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("accuracy"))


def confusion_pairs(df: DataFrame) -> DataFrame:
    """label, pred, n of the pairs of classes that occur."""
    return df.groupBy("label", "pred").agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, max_classes: int = MAX_GRID) -> DataFrame:
    """label, pred, n for all pairs of classes seen as label or prediction; pairs that never occur have 0.

    The grid joins the classes with themselves, not rows with rows. More than max_classes classes are an error: their grid would hold
    a million pairs and more, nearly all 0; confusion_pairs gives the others.
    """
    counts = saved(confusion_pairs(df))
    classes = counts.select(F.col("label").alias("c")).union(counts.select("pred")).distinct()
    found = classes.limit(max_classes + 1).agg(F.array_sort(F.collect_set("c")).alias("cs"))
    if found.select(F.size("cs")).first()[0] > max_classes:
        raise ValueError(f"more than {max_classes} classes; use confusion_pairs")
    grid = found.select(F.explode("cs").alias("label"), "cs").select("label", F.explode("cs").alias("pred"))
    return grid.join(counts, ["label", "pred"], "left").select("label", "pred", F.coalesce("n", F.lit(0)).alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / F.nullif(b, F.lit(0)))


def class_scores(df: DataFrame) -> DataFrame:
    """class, support, n_pred, hits, precision, recall, f1 over labels and predictions; a zero divisor gives 0."""
    return scores_of_pairs(confusion_pairs(df))


def scores_of_pairs(counts: DataFrame) -> DataFrame:
    """class_scores from the counts of pairs."""
    hit = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)
    true = counts.select(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).alias("n_pred"), hit.alias("hits"))
    made = counts.select(F.col("pred").alias("class"), F.lit(0).alias("support"), F.col("n").alias("n_pred"), F.lit(0).alias("hits"))
    sums = true.unionByName(made).groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "n_pred", "hits")])
    p, r = _ratio(F.col("hits"), F.col("n_pred")), _ratio(F.col("hits"), F.col("support"))
    return sums.withColumns({"precision": p, "recall": r}).withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def averaged(df: DataFrame, average: str | None = None) -> DataFrame:
    """precision, recall, f1 as one row: `binary` (class 1) if there are exactly two labels, else `macro`; or micro, weighted."""
    return averages_of(class_scores(df), average)


def averages_of(scores: DataFrame, average: str | None = None) -> DataFrame:
    """averaged, from class_scores."""
    if average is None:
        average = "binary" if scores.filter("support > 0").count() == 2 else "macro"
    names = ("precision", "recall", "f1")
    if average not in ("binary", "micro", "macro", "weighted"):
        raise ValueError(f"unknown average: {average}")
    if average == "binary":
        return scores.agg(*[F.coalesce(F.max(F.when(F.col("class") == 1, F.col(c))), F.lit(0.0)).alias(c) for c in names])
    if average == "micro":
        p, r = _ratio(F.sum("hits"), F.sum("n_pred")), _ratio(F.sum("hits"), F.sum("support"))
        return scores.agg(p.alias("precision"), r.alias("recall")).withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    weight = F.col("support") if average == "weighted" else F.lit(1)
    return scores.agg(*[_ratio(F.sum(F.col(c) * weight), F.sum(weight)).alias(c) for c in names])


def classification_report(df: DataFrame) -> DataFrame:
    """class, precision, recall, f1, support for each class, and rows `accuracy`, `macro avg`, `weighted avg`."""
    return report_of(saved(class_scores(df)))


def report_of(scores: DataFrame) -> DataFrame:
    """classification_report, from class_scores."""
    n = F.sum("support")
    each = scores.select(F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    right = _ratio(F.sum("hits"), n)
    overall = scores.agg(F.lit("accuracy").alias("class"), right.alias("precision"), right.alias("recall"), right.alias("f1"), n.alias("support"))
    for name, weight in (("macro avg", F.lit(1)), ("weighted avg", F.col("support"))):
        row = scores.agg(F.lit(name).alias("class"), *[_ratio(F.sum(F.col(c) * weight), F.sum(weight)).alias(c) for c in ("precision", "recall", "f1")], n.alias("support"))
        overall = overall.unionByName(row)
    return each.unionByName(overall)


def by_score(df: DataFrame, bins: int | None = None) -> DataFrame:
    """score, pos, neg, tp, fp: rows are first counted by score (or by bin of score), then summed from the highest score down."""
    score = F.round(F.col("score") * bins) / bins if bins else F.col("score")
    positive = (F.col("label") == 1).cast("long")
    counts = saved(df.groupBy(score.cast("double").alias("score")).agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")))
    return running_sums(counts, [-F.col("score")], {"tp": "pos", "fp": "neg"})


def roc_auc(df: DataFrame, bins: int | None = None) -> DataFrame:
    """roc_auc of (label 0/1, score) as one row; ties count half; NULL if there is one class only."""
    above = by_score(df, bins)
    won = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") / 2.0))
    return above.agg((won / F.nullif(F.sum("pos").cast("double") * F.sum("neg"), F.lit(0.0))).alias("roc_auc"))


def roc_auc_multiclass(df: DataFrame, multi_class: str = "ovr") -> DataFrame:
    """The mean AUC of (label, scores): `ovr`, each class that is a label against the rest; `ovo`, each pair of such classes, both ways.

    All classes, or ordered pairs of classes, are ranked in one pass, by (class, score).
    """
    each = df.select("label", F.posexplode("scores").alias("class", "score"))
    positive = (F.col("label") == F.col("class")).cast("long")
    if multi_class == "ovr":
        cells = each.select(F.col("class").alias("side"), F.col("score").cast("double").alias("score"), positive.alias("pos"), (1 - positive).alias("neg"))
    elif multi_class == "ovo":  # of class a: its own rows against those of each other label b, by the score of a
        labels = [r[0] for r in df.select("label").distinct().limit(MAX_GRID + 1).collect()]
        if len(labels) > MAX_GRID:
            raise ValueError(f"more than {MAX_GRID} classes are compared with each other")
        others = F.filter(F.array(*[F.lit(x) for x in labels]), lambda x: x != F.col("class"))
        against = F.when(positive == 1, others).otherwise(F.array(F.col("label")))
        # rows of a are counted once for each score, and only then set against each other label
        counted = each.filter(F.col("class").isin(labels)).groupBy("class", "label", "score").agg(F.count("*").alias("m"))
        met = counted.select("class", F.explode(against).alias("b"), F.col("score").cast("double").alias("score"), (positive * F.col("m")).alias("pos"), ((1 - positive) * F.col("m")).alias("neg"))
        cells = met.select(F.struct("class", "b").alias("side"), "score", "pos", "neg")
    else:
        raise ValueError(f"unknown multi_class: {multi_class}")
    counts = saved(cells.groupBy("side", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    summed = running_sums(counts, [F.col("side"), -F.col("score")], {"tp": "pos"})
    # running sums go on from side to side: what earlier ones had is taken off again
    total = summed.groupBy("side").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.min(F.col("tp") - F.col("pos")).alias("base"))
    won = F.sum(F.col("neg") * (F.col("tp") - F.col("base") - F.col("pos") + F.col("pos") / 2.0))
    aucs = summed.join(total, "side").groupBy("side", "p", "n").agg(won.alias("won")).filter("p > 0 AND n > 0")
    return aucs.agg(F.avg(F.col("won") / (F.col("p") * F.col("n"))).alias("roc_auc"))


def roc_curve(df: DataFrame, drop_collinear: bool = False) -> DataFrame:
    """fpr, tpr, threshold for every score, and (0, 0, infinity).

    drop_collinear: without the points that lie between their neighbours on a line, in equal steps. A point stays if the step to it differs from the step after it, so
    each score needs its neighbour only: within a range by a window, across a range's border by the first score of the next range, one row a range.
    """
    points = corners(df) if drop_collinear else by_score(df)
    total = df.agg(F.coalesce(F.sum((F.col("label") == 1).cast("long")), F.lit(0)).alias("p"), F.coalesce(F.sum((F.col("label") != 1).cast("long")), F.lit(0)).alias("n"))
    curve = points.join(F.broadcast(total)).select(_ratio(F.col("fp"), F.col("n")).alias("fpr"), _ratio(F.col("tp"), F.col("p")).alias("tpr"), F.col("score").alias("threshold"))
    return curve.union(total.select(F.lit(0.0), F.lit(0.0), F.lit(float("inf"))))


def corners(df: DataFrame) -> DataFrame:
    """The rows of by_score without those whose step (pos, neg) is that of the next lower score; the last stays."""
    order = [-F.col("score")]
    dealt = saved(by_range(by_score(df), order))
    following = F.lead(F.struct("pos", "neg")).over(Window.partitionBy(PART).orderBy(*order))
    heads = dealt.groupBy(PART).agg(F.max_by(F.struct("pos", "neg"), "score").alias("head")).collect()  # one row for each range
    after, later = [], None
    for row in sorted(heads, key=lambda r: -r[PART]):
        after.append((row[PART], later))
        later = (row["head"]["pos"], row["head"]["neg"])
    entering = df.sparkSession.createDataFrame(after, f"{PART} int, __after struct<pos:long,neg:long>")
    return dealt.withColumn("__next", following).join(F.broadcast(entering), PART).filter(F.coalesce("__next", "__after").isNull() | (F.struct("pos", "neg") != F.coalesce("__next", "__after"))).drop("__next", "__after", PART)


def precision_recall_curve(df: DataFrame) -> DataFrame:
    """precision, recall, threshold for every score, and (1, 0, NULL)."""
    points = by_score(df)
    total = points.agg(F.sum("pos").alias("p"))
    curve = points.join(F.broadcast(total)).select(_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), _ratio(F.col("tp"), F.col("p")).alias("recall"), F.col("score").alias("threshold"))
    return curve.union(total.select(F.lit(1.0), F.lit(0.0), F.lit(None).cast("double")))


def regression(df: DataFrame) -> DataFrame:
    """mse, mae, rmse, r2_score of (label, score) in one pass."""
    error = F.col("label") - F.col("score")
    mse, spread = F.avg(error * error), F.var_pop("label")
    return df.agg(mse.alias("mse"), F.avg(F.abs(error)).alias("mae"), F.sqrt(mse).alias("rmse"), (1 - mse / F.nullif(spread, F.lit(0.0))).alias("r2_score"))


def _overlap(threshold: float) -> list[Column]:
    count = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    over = lambda c: F.transform(c, lambda x: F.when(x > threshold, 1).otherwise(0))
    p, t = over(F.col("pred")), over(F.col("truth"))
    return [F.sum(count(p)).alias("p"), F.sum(count(t)).alias("t"), F.sum(count(F.zip_with(p, t, lambda a, b: a * b))).alias("both")]


def segmentation(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """dice_score and jaccard_index over all pixels of all masks (pred, truth arrays).

    Pixels are counted inside the arrays. These are the textbook measures: no 8-bit overflow of mask products.
    """
    sums = df.agg(*_overlap(threshold))
    union = F.col("p") + F.col("t") - F.col("both")
    return sums.select((2.0 * F.col("both") / (F.col("p") + F.col("t") + 1e-6)).alias("dice_score"), _ratio(F.col("both"), union).alias("jaccard_index"))


def nearest_squared(mask: np.ndarray, many: bool = False) -> np.ndarray:
    """For each cell the exact squared distance to the nearest cell that is set, in a mask of any number of axes with a cell set. many: the first axis counts masks.

    One axis at a time: along the last by running maxima, along each other by the lower envelope of parabolas, all lines of the axis at once. Work grows with the cells.
    """
    n = mask.shape[-1]
    place, far = np.arange(n), 2 * sum(mask.shape[many:])
    before = np.maximum.accumulate(np.where(mask, place, -far), axis=-1)
    after = np.minimum.accumulate(np.where(mask, place, n + far)[..., ::-1], axis=-1)[..., ::-1]
    squared = np.minimum(np.minimum(place - before, after - place), far).astype(np.int64) ** 2
    for axis in range(mask.ndim - 2, int(many) - 1, -1):
        lines = np.moveaxis(squared, axis, 0)
        squared = np.moveaxis(_envelope(lines.reshape(lines.shape[0], -1)).reshape(lines.shape), 0, axis)
    return squared


def _envelope(f: np.ndarray) -> np.ndarray:
    """min over i of (u - i)^2 + f[i] for each u down the first axis, for all columns at once, in whole numbers."""
    n, m = f.shape
    vertex, begin = np.zeros((n, m), dtype=np.int64), np.zeros((n, m), dtype=np.int64)  # parabolas of each column's envelope, and where each begins to be lowest
    top, column = np.zeros(m, dtype=np.int64), np.arange(m)
    for u in range(1, n):
        open_ = column
        while len(open_):  # parabolas that the new one hides from their own beginning on
            i, t = vertex[top[open_], open_], begin[top[open_], open_]
            open_ = open_[(t - i) ** 2 + f[i, open_] > (t - u) ** 2 + f[u, open_]]
            top[open_] -= 1
            open_ = open_[top[open_] >= 0]
        empty = top < 0
        top[empty] = 0
        vertex[0, empty] = u
        c = column[~empty]
        i = vertex[top[c], c]
        lowest_from = 1 + (u * u - i * i + f[u, c] - f[i, c]) // (2 * (u - i))
        fits = lowest_from < n
        c = c[fits]
        top[c] += 1
        vertex[top[c], c], begin[top[c], c] = u, lowest_from[fits]
    out = np.empty_like(f)
    for u in range(n - 1, -1, -1):
        i = vertex[top, column]
        out[u] = (u - i) ** 2 + f[i, column]
        top[begin[top, column] == u] -= 1
        np.maximum(top, 0, out=top)
    return out


def mask_distances(pred: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """The larger directed distance between the masks of each pair; infinity if one is empty. The first axis counts the pairs."""
    if not pred.size:
        return np.full(len(pred), np.inf)
    over = tuple(range(1, pred.ndim))
    farthest = lambda of, to: np.where(of, nearest_squared(to, True), 0).max(axis=over)
    found = np.sqrt(np.maximum(farthest(pred, truth), farthest(truth, pred)).astype(float))
    return np.where(pred.any(axis=over) & truth.any(axis=over), found, np.inf)


def mask_distance(pred: np.ndarray, truth: np.ndarray) -> float:
    return float(mask_distances(pred[None], truth[None])[0])


#: Cells of masks that are measured at once; a larger mask is measured by itself.
CELLS = 1 << 20


def hausdorff_each(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """image_id, distance between the masks pred and truth of each image, by exact distance transforms.

    The masks are arrays of pixels by rows of `width`, or of any shape that a column `shape` (array<int>, slowest axis first) gives: planes, rows, columns for a volume.
    """
    shaped = "shape" in df.columns

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [[np.asarray(m, dtype=float) > threshold for m in (p, t)] for p, t in zip(batch["pred"], batch["truth"], strict=True)]
            forms = [tuple(int(x) for x in s) for s in batch["shape"]] if shaped else [(len(p) // int(w), int(w)) for (p, _), w in zip(pairs, batch["width"], strict=True)]
            found, alike = np.empty(len(batch)), defaultdict(list)
            for k, form in enumerate(forms):
                alike[form].append(k)
            for form, rows in alike.items():  # masks of one shape together, CELLS of them at once
                step = max(1, CELLS // max(1, int(np.prod(form))))
                for i in range(0, len(rows), step):
                    some = rows[i : i + step]
                    found[some] = mask_distances(*(np.stack([pairs[k][j].reshape(form) for k in some]) for j in (0, 1)))
            yield pd.DataFrame({"image_id": batch["image_id"], "distance": found})

    return df.select("image_id", "pred", "truth", "shape" if shaped else "width").mapInPandas(each, "image_id long, distance double")


def hausdorff_distance(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The largest distance over the images, each measured by itself."""
    return hausdorff_each(df, threshold).agg(F.max("distance").alias("hausdorff_distance"))


def default_metrics(task: str) -> list[str]:
    """What is measured when nothing is asked for."""
    defaults = {"binary": ["classification_report", "roc_auc"], "multiclass": ["classification_report"], "segmentation": ["dice_score", "jaccard_index"], "regression": ["mse", "mae", "r2_score"]}
    if task not in defaults:
        raise ValueError(f"unknown task: {task}")
    return defaults[task]


SCALARS = ("accuracy", "precision", "recall", "f1_score", "roc_auc", "mse", "mae", "rmse", "r2_score", "dice_score", "jaccard_index", "hausdorff_distance")
TABLES = {"confusion_matrix": confusion_matrix, "classification_report": classification_report, "roc_curve": roc_curve, "precision_recall_curve": precision_recall_curve}


def evaluation_tables(df: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    """Those of the named metrics that are tables: confusion_matrix, classification_report, roc_curve, precision_recall_curve."""
    return {name: TABLES[name](df) for name in names if name in TABLES}


#: Ranges of scores that are ranked by themselves; their borders are literals in the plan.
RANGES = 1000


class _Measures:
    """The values that metrics share. The predictions are read once: they are counted by (label, pred, score) and written, and what is observed on the way (rows,
    moments, borders of the scores) comes with that. Averages and reports come from the classes' counts, AUCs from one ranked pass over the counts."""

    CLASSES = ("accuracy", "precision", "recall", "f1_score", "classification_report")
    MOMENTS = ("mse", "mae", "rmse", "r2_score")

    def __init__(self, df: DataFrame, metrics: list[tuple[str, dict]]) -> None:
        self.df, self.made = df, {}
        names = {name for name, params in metrics if not (name == "roc_auc" and "multi_class" in params)}
        self.by_class, self.ranked, self.moments = bool(names & set(self.CLASSES)), "roc_auc" in names, bool(names & set(self.MOMENTS))
        asked = {"label"} | ({"pred"} if self.by_class else set()) | ({"score"} if self.ranked else set())
        self.columns = [c for c in ("label", "pred", "score") if c in asked & set(df.columns)]

    def once(self, name: str, make):
        if name not in self.made:
            self.made[name] = make()
        return self.made[name]

    def has(self, *columns: str) -> None:
        if missing := [c for c in columns if c not in self.df.columns]:
            raise ValueError(f"no column {', '.join(missing)}")

    def counted(self) -> tuple[DataFrame, dict]:
        """Counts by the columns in use, and what was observed while they were written."""

        def made() -> tuple[DataFrame, dict]:
            number = lambda c: F.col(c).try_cast("double")
            seen = {"rows": F.count(F.lit(1))}
            if self.moments and {"label", "score"} <= set(self.df.columns):
                y, error = number("label"), number("label") - number("score")
                seen |= {"mse": F.avg(error * error), "mae": F.avg(F.abs(error)), "spread": F.var_pop(y), "odd": F.count_if((y.isNull() & F.col("label").isNotNull()) | (number("score").isNull() & F.col("score").isNotNull()))}
            if self.ranked and "score" in self.columns:
                parts = min(RANGES, int(self.df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
                seen["borders"] = F.percentile_approx(number("score"), [k / parts for k in range(1, parts)] or [0.5])
            observation, path = Observation(), new_folder(self.df.sparkSession, "counts")
            counts = self.df.observe(observation, *[v.alias(k) for k, v in seen.items()]).groupBy(*self.columns).agg(F.count("*").alias("n"))
            counts.write.parquet(path)
            try:
                found = observation.get
            except Py4JError:
                if not self.df.isEmpty():
                    raise
                found = {"rows": 0}  # nothing is observed in a plan that the optimiser knows to be empty
            return self.df.sparkSession.read.schema(counts.schema).parquet(path), found

        return self.once("counted", made)

    def rows(self) -> int:
        return self.counted()[1]["rows"] if self.by_class or self.ranked else 0 if self.df.isEmpty() else 1

    def class_rows(self) -> list | None:
        """class_scores of all classes, or None if there are more than MAX_GRID."""
        self.has("label", "pred")
        found = self.once("classes", lambda: scores_of_pairs(self.pairs()).limit(MAX_GRID + 1).collect())
        return found if len(found) <= MAX_GRID else None

    def pairs(self) -> DataFrame:
        return self.counted()[0].select("label", "pred", "n")

    def averages(self, average: str | None) -> dict[str, float]:
        rows, names = self.class_rows(), ("precision", "recall", "f1")
        if rows is None:
            return averages_of(saved(scores_of_pairs(self.pairs())), average).first().asDict()
        average = average or ("binary" if sum(r["support"] > 0 for r in rows) == 2 else "macro")
        share = lambda a, b: a / b if b else 0.0
        if average == "binary":
            one = [r for r in rows if r["class"] is not None and float(r["class"]) == 1]
            return {c: one[0][c] if one else 0.0 for c in names}
        if average == "micro":
            hits = sum(r["hits"] for r in rows)
            p, r_ = share(hits, sum(r["n_pred"] for r in rows)), share(hits, sum(r["support"] for r in rows))
            return {"precision": p, "recall": r_, "f1": share(2 * p * r_, p + r_)}
        if average not in ("macro", "weighted"):
            raise ValueError(f"unknown average: {average}")
        weights = [r["support"] if average == "weighted" else 1 for r in rows]
        return {c: share(sum(r[c] * w for r, w in zip(rows, weights, strict=True)), sum(weights)) for c in names}

    def accuracy(self) -> float:
        rows = self.class_rows()
        if rows is None:
            return self.pairs().agg(_ratio(F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)), F.sum("n"))).first()[0]
        return sum(r["hits"] for r in rows) / self.counted()[1]["rows"]

    def report(self) -> dict[str, float]:
        rows = self.class_rows()
        if rows is None:
            raise ValueError(f"more than {MAX_GRID} classes; see evaluation_tables")
        cells = ("precision", "recall", "f1", "support")
        text = lambda c: "NULL" if c is None else str(c)
        named = {text(r["class"]): {c: r[c] for c in cells} for r in rows}
        support, hits = sum(r["support"] for r in rows), sum(r["hits"] for r in rows)
        right = hits / support if support else 0.0
        named |= {"accuracy": {"precision": right, "recall": right, "f1": right, "support": support}}
        named |= {f"{how} avg": {**self.averages(how), "support": support} for how in ("macro", "weighted")}
        return {f"classification_report.{name}.{c}": named[name][c] for name in sorted(named) for c in cells}

    def auc(self, bins: int | None) -> float | None:
        """The AUC of (label 0/1, score): each range of scores by itself, ties at half, and one row a range at the driver."""
        self.has("label", "score")
        counts, seen = self.counted()
        score = F.col("score").cast("double")
        score = F.round(score * bins) / bins if bins else score
        cuts = F.lit(np.array(sorted(set(seen["borders"] or [])), dtype=float))
        positive = F.col("label") == 1
        dealt = counts.select(score.alias("score"), F.when(positive, F.col("n")).otherwise(0).alias("pos"), F.when(positive, 0).otherwise(F.col("n")).alias("neg"))
        dealt = dealt.withColumn(PART, F.size(F.filter(cuts, lambda c: c < F.col("score"))))
        down = Window.partitionBy(PART).orderBy(F.desc("score"))
        above, equal = F.sum("pos").over(down.rangeBetween(Window.unboundedPreceding, Window.currentRow)), F.sum("pos").over(down.rangeBetween(Window.currentRow, Window.currentRow))
        won = dealt.select(PART, "pos", "neg", (F.col("neg") * (above - equal / 2.0)).alias("won"))
        total, before, negatives = 0.0, 0, 0
        for r in sorted(won.groupBy(PART).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.sum("won").alias("won")).collect(), key=lambda r: -r[PART]):
            total, before, negatives = total + r["won"] + float(r["n"]) * before, before + r["p"], negatives + r["n"]
        return total / (float(before) * negatives) if before and negatives else None

    def moment(self, name: str) -> float | None:
        self.has("label", "score")
        if not (self.by_class or self.ranked):
            return self.once("regression", lambda: regression(self.df).first())[name]
        seen = self.counted()[1]
        if seen["odd"]:
            raise ValueError(f"{seen['odd']} labels or scores that are no numbers")
        mse, spread = seen["mse"], seen["spread"]
        return {"mse": mse, "mae": seen["mae"], "rmse": None if mse is None else mse**0.5, "r2_score": 1 - mse / spread if mse is not None and spread else None}[name]

    def values(self, name: str, params: dict) -> dict[str, float | None]:
        """The value of a scalar metric, or each cell of a report or matrix."""
        if name == "accuracy":
            return {name: self.accuracy()}
        if name in ("precision", "recall", "f1_score"):
            average = params.get("average")
            return {name: self.once(f"average {average}", lambda: self.averages(average))["f1" if name == "f1_score" else name]}
        if name == "roc_auc" and "multi_class" in params:
            return {name: roc_auc_multiclass(self.df, params["multi_class"]).first()[0]}
        if name == "roc_auc":
            bins = params.get("bins")
            return {name: self.once(f"auc {bins}", lambda: self.auc(bins))}
        if name in self.MOMENTS:
            return {name: self.moment(name)}
        if name in ("dice_score", "jaccard_index"):
            threshold = params.get("threshold", 0.5)
            return {name: self.once(f"masks {threshold}", lambda: segmentation(self.df, threshold).first())[name]}
        if name == "hausdorff_distance":
            return {name: hausdorff_distance(self.df, params.get("threshold", 0.5)).first()[0]}
        if name == "classification_report":
            return self.report()
        raise ValueError("unknown metric" if name not in TABLES else "a table, see evaluation_tables")


def evaluate(df: DataFrame, metrics: list[str | dict], average: str | None = None) -> DataFrame:
    """metric, value (double), note: a long table of metrics of (label, score, pred), (label, scores, pred) or masks (pred, truth, width).

    A metric is a name or {"name", "params"}; params are average, multi_class, bins or threshold. A report gives a row for each of its cells; curves and the
    confusion matrix are tables of their own (evaluation_tables). Unknown metrics, and those that fail on these
    predictions, become a row with a note, and the others still come. What metrics share (counts of pairs, moments) is read once.
    """
    asked = [(m, {}) if isinstance(m, str) else (m["name"], m.get("params") or {}) for m in metrics]
    measures, rows = _Measures(df, asked), []
    if not measures.rows():
        raise ValueError("no predictions")
    for name, params in asked:
        try:
            found = measures.values(name, ({"average": average} if average else {}) | params)
            rows += [(k, None if v is None else float(v), "undefined: one class only" if v is None else None) for k, v in found.items()]
        except (PySparkException, Py4JError, ValueError, TypeError) as e:
            rows.append((name, None, str(e).splitlines()[0][:300]))
    return df.sparkSession.createDataFrame(rows, "metric string, value double, note string")


def utility_loss(baseline: DataFrame, private: DataFrame) -> DataFrame:
    """metric, loss: baseline value less private value, for metrics in both tables."""
    other = private.select("metric", F.col("value").alias("private"))
    return baseline.select("metric", "value").join(other, "metric").select("metric", (F.col("value") - F.col("private")).alias("loss"))
