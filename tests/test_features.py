"""Image bytes, folders, array features, two-level losses, second-order trees, file pairs, curves, hot links, distances and the guard."""

import os
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.functions.images import image_tensor
from tributary.operators import link, losses, metrics, scale, trees, vectors
from tributary.sources import folders, tables

# ---- images


def png(path, rows, kind):
    """A PNG of rows of bytes; kind 0 grey, 2 colour, 6 colour with alpha."""
    height, width = len(rows), len(rows[0]) // {0: 1, 2: 3, 6: 4}[kind]
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    body = b"".join(b"\0" + bytes(r) for r in rows)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b""))


def test_tensors_of_png_files(spark, tmp_path):
    png(tmp_path / "grey.png", [[0, 255], [51, 102]], 0)
    png(tmp_path / "colour.png", [[255, 0, 0, 0, 255, 0], [0, 0, 255, 10, 20, 30]], 2)
    png(tmp_path / "alpha.png", [[255, 0, 0, 128]], 6)
    got = {os.path.basename(r.path): r.tensor for r in tables.read_image_tensors(spark, str(tmp_path)).collect()}
    whole = lambda t: [round(v * 255) for v in t["values"]]
    assert got["grey.png"]["shape"] == [1, 2, 2] and whole(got["grey.png"]) == [0, 255, 51, 102]
    assert got["colour.png"]["shape"] == [3, 2, 2] and whole(got["colour.png"]) == [255, 0, 0, 10, 0, 255, 0, 20, 0, 0, 255, 30]
    assert got["alpha.png"]["shape"] == [4, 1, 1] and whole(got["alpha.png"]) == [255, 0, 0, 128]
    flat = {os.path.basename(r.path): r.tensor for r in tables.read_image_tensors(spark, str(tmp_path), "hwc", threshold=0.3).collect()}
    assert flat["colour.png"]["shape"] == [2, 2, 3] and flat["colour.png"]["values"] == [1, 0, 0, 0, 1, 0, 0, 0, 1, 0, 0, 0]
    grey = {os.path.basename(r.path): r.tensor for r in tables.read_image_tensors(spark, str(tmp_path), grayscale=True).collect()}
    assert whole(grey["colour.png"]) == [76, 150, 29, 18] and whole(grey["alpha.png"]) == [76] and whole(grey["grey.png"]) == [0, 255, 51, 102]


def test_odd_image_bytes(spark):
    rows = [(1, bytearray([1, 2, 3]), 1, 1, 3), (2, None, 1, 1, 3), (3, bytearray(), 0, 0, 1), (3, bytearray([9]), 1, 1, 1)]
    df = spark.createDataFrame(rows, "id int, data binary, height int, width int, channels int")
    tensor = image_tensor(*[F.col(c) for c in ("data", "height", "width", "channels")], unit=False)
    got = [(r.id, r.t and (r.t["shape"], r.t["values"])) for r in df.select("id", tensor.alias("t")).orderBy("id").collect()]
    assert got[:2] == [(1, ([3, 1, 1], [3.0, 2.0, 1.0])), (2, None)] and sorted(got[2:]) == [(3, ([1, 0, 0], [])), (3, ([1, 1, 1], [9.0]))]
    assert df.limit(0).select(tensor.alias("t")).count() == 0
    with pytest.raises(Exception, match="pixels"):
        df.withColumn("width", F.lit(2)).select(tensor.alias("t")).collect()
    with pytest.raises(ValueError, match="layout"):
        image_tensor(F.col("data"), F.col("height"), F.col("width"), F.col("channels"), "whc")


# ---- folders


def test_folders_are_merged(spark, tmp_path):
    for name, text in {"a/x.txt": "a", "a/deep/er/y.txt": "ay", "b/x.txt": "b", "b/deep/z [1].txt": "bz", "b/deep/er/y.txt": "by", "b/only/w.txt": "w"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    (tmp_path / "a/empty").mkdir()
    os.symlink(tmp_path / "b/x.txt", tmp_path / "a/link.txt")
    os.symlink(tmp_path / "b", tmp_path / "a/deep/loop")
    (tmp_path / "file").write_text("no folder")
    roots = {"b": f"file://{tmp_path}/b", "a": str(tmp_path / "a"), "gone": str(tmp_path / "gone"), "file": str(tmp_path / "file")}
    listed = folders.list_folders(spark, roots)
    union = folders.folder_union(listed, ["a", "b", "gone", "file"])
    got = {(r.relative_path, r.kind): r.provider for r in union.filter("kind <> 'missing'").collect()}
    assert got == {
        ("x.txt", "file"): "a", ("deep", "folder"): "a", ("deep/er", "folder"): "a", ("deep/er/y.txt", "file"): "a", ("empty", "folder"): "a", ("deep/z [1].txt", "file"): "b",
        ("only", "folder"): "b", ("only/w.txt", "file"): "b",
    }
    assert sorted(r.provider for r in union.filter("kind = 'missing'").collect()) == ["file", "gone"]
    copied = folders.copy_files(union, str(tmp_path / "out"))
    assert copied.filter("kind = 'file'").count() == 4 and (tmp_path / "out/empty").is_dir()
    assert {str(p.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("*") if p.is_file()} == {"x.txt": "a", "deep/er/y.txt": "ay", "deep/z [1].txt": "bz", "only/w.txt": "w"}
    assert folders.folder_union(listed, ["b"]).filter("provider = 'a'").count() == 0


# ---- array features


def test_five_thousand_features_in_one_small_plan(spark):
    wide = spark.range(40).select(F.col("id"), F.transform(F.sequence(F.lit(1), F.lit(5000)), lambda k: (F.col("id") * k % 17).cast("double")).alias("features"))
    values = np.array([r.features for r in wide.orderBy("id").collect()])
    done = vectors.scale_features(wide, "features", "standard")
    assert done._jdf.queryExecution().optimizedPlan().toString().count("zip_with") <= 2 and len(done._jdf.queryExecution().optimizedPlan().toString().splitlines()) < 10
    got = np.array([r.features for r in done.orderBy("id").collect()])
    spread = values.std(axis=0)
    assert np.allclose(got, (values - values.mean(axis=0)) / np.where(spread == 0, 1, spread))
    found = {r.feature: (r.least, r.most) for r in vectors.bounds(wide, "features").collect()}
    assert len(found) == 5000 and found[7] == (values[:, 7].min(), values[:, 7].max())
    means = vectors.mean_bounds(vectors.bounds(wide, "features")).first()
    assert means.least == pytest.approx(values.min(axis=0).mean()) and means.most == pytest.approx(values.max(axis=0).mean())


@pytest.mark.parametrize("method", ["standard", "minmax", "robust"])
def test_missing_values_stay_out_of_the_fit(spark, method):
    rows = [(1, [1.0, None, 5.0]), (2, [3.0, 2.0, float("nan")]), (3, [8.0, 4.0, 7.0]), (4, None), (5, [2.0, 9.0, 7.0])]
    df = spark.createDataFrame(rows, "id int, x array<double>")
    got = {r.id: r.x for r in vectors.scale_features(df, "x", method, missing=True).collect()}
    table = np.array([[np.nan if v is None else v for v in x] for _, x in rows if x])
    shift, width = {"standard": (np.nanmean(table, 0), np.nanstd(table, 0)), "minmax": (np.nanmin(table, 0), np.nanmax(table, 0) - np.nanmin(table, 0)),
        "robust": (np.nanmedian(table, 0), np.nanquantile(table, 0.75, axis=0) - np.nanquantile(table, 0.25, axis=0))}[method]
    assert got[4] is None and got[1][1] is None and np.isnan(got[2][2])
    assert np.allclose([got[i] for i in (3, 5)], (table[[2, 3]] - shift) / width)
    assert vectors.scale_features(df.limit(0), "x", method).count() == 0


def test_missing_values_are_an_error_if_not_expected(spark):
    with pytest.raises(ValueError, match="missing"):
        vectors.fit(spark.createDataFrame([([1.0, float("nan")],), ([2.0, 3.0],)], "x array<double>"), "x", "standard")


@pytest.mark.parametrize("n", [1, 5, 9_999, 10_000, 40_000])
def test_exact_quartiles_of_many_values(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.normal(size=n) * (3 if n % 2 else 1000), 0 if n == 40_000 else 6)
    df = spark.createDataFrame(list(enumerate(values.tolist())), "id int, v double").withColumn("w", -F.col("v"))
    got = scale.quartiles(df, ["v", "w"])
    assert np.allclose(got[0], np.quantile(values, [0.25, 0.5, 0.75])) and np.allclose(got[1], np.quantile(-values, [0.25, 0.5, 0.75]))


def test_quartiles_by_range_when_the_driver_may_not_add_up(spark, monkeypatch):
    monkeypatch.setattr(scale, "COLLECTED", 3)
    values = np.random.default_rng(1).normal(size=20_000)
    df = spark.createDataFrame(list(enumerate(values.tolist())), "id int, v double")
    assert np.allclose(scale.quartiles(df, ["v"])[0], np.quantile(values, [0.25, 0.5, 0.75]))


# ---- losses


def test_nested_losses_equal_plain_ones(spark):
    rng = np.random.default_rng(2)
    p, y = rng.uniform(0.05, 0.95, 50), rng.integers(0, 2, 50).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(p, y, strict=True)], "p double, y double")
    known = {"bce": losses.Loss(losses.bce_loss(F.col("p"), F.col("y"))), "l1": losses.Loss(F.abs(F.col("p") - F.col("y"))), "dice": losses.soft_dice_of_set(F.col("p"), F.col("y"))}
    bce, l1 = -(y * np.log(p) + (1 - y) * np.log(1 - p)), np.abs(p - y)
    dice = 1 - (2 * (p * y).sum() + 1e-5) / ((p * p).sum() + (y * y).sum() + 1e-5)
    value = lambda config: losses.test_loss(df, losses.composed(config, known)).first()[0]
    parts = {"b": "bce", "l": "l1", "d": "dice"}
    for how, reduce in (("mean", np.mean), ("sum", np.sum)):
        assert value({"expression": "d + 0.5 * b", "components": parts, "reduction": how}) == pytest.approx(reduce(dice + 0.5 * bce))
        assert value({"expression": "b * l ** g - (l - d) / 2", "components": parts, "variables": {"g": 3}, "reduction": how}) == pytest.approx(reduce(bce * l1**3 - (l1 - dice) / 2))
        nested = {"expression": "b + d", "components": {"b": {"expression": "x * x", "components": {"x": "l1"}, "reduction": "sum"}, "d": "dice"}, "reduction": how}
        assert value({"expression": "2 * n * b", "components": {"n": nested, "b": "bce"}, "reduction": how}) == pytest.approx(reduce(2 * ((l1 * l1).sum() + dice) * bce))
        assert value({"expression": "d", "components": parts, "reduction": how}) == pytest.approx(dice)
    plan = losses.test_loss(df, losses.composed({"expression": "d + 0.5 * b", "components": parts}, known))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    for bad, what in (({"expression": "b * d ** b", "components": parts}, "linear"), ({"expression": "__import__('os')", "components": parts}, "not allowed"), ({"expression": "b", "components": parts, "reduction": "max"}, "reduction")):
        with pytest.raises(ValueError, match=what):
            losses.composed(bad, known)


# ---- trees


def plain_tree(x, g, h, borders, depth, step, l2, least, k=0):
    """Nodes of one tree by exhaustive search over borders; missing values are NaN."""
    value, best = -g.sum() / (h.sum() + l2) * step, None
    score = lambda m: g[m].sum() ** 2 / (h[m].sum() + l2)
    for f, cuts in enumerate(borders):
        for b, cut in enumerate([*cuts, np.inf]):
            for missing_left in (True, False):
                left = np.where(np.isnan(x[:, f]), missing_left, x[:, f] <= cut)
                if min(h[left].sum(), h[~left].sum()) < max(least, 1e-12):
                    continue
                gain = score(left) + score(~left) - g.sum() ** 2 / (h.sum() + l2)
                if gain > 1e-9 * (1 + g.sum() ** 2 / (h.sum() + l2)) and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, b, missing_left, left)
    if depth == 0 or best is None:
        return {k: (None, value)}
    gain, f, b, missing_left, left = best
    rest = [plain_tree(x[m], g[m], h[m], borders, depth - 1, step, l2, least, 2 * k + j) for m, j in ((left, 1), (~left, 2))]
    return {k: (f, b, round(gain, 6)), **rest[0], **rest[1]}


@pytest.mark.parametrize("logistic", [True, False])
def test_trees_equal_an_exhaustive_search(spark, logistic):
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(400, 3)), 1)
    x[rng.random((400, 3)) < 0.1] = np.nan
    signal = np.nan_to_num(x[:, 0], nan=1.0) + (np.nan_to_num(x[:, 1]) > 0.3) + rng.normal(size=400) * 0.3
    y = (signal > 0.5).astype(float) if logistic else signal
    rows = [(*[None if np.isnan(v) else float(v) for v in r], float(t)) for r, t in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    borders = trees.borders_of(df, ["a", "b", "c"], bins=8)
    model = trees.fit(df, ["a", "b", "c"], "y", trees=2, depth=3, step=0.3, l2=2.0, min_child_weight=3.0, logistic=logistic, borders=borders, positive_weight=1.0)
    margin = np.zeros(400)
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        g, h = (p - y, p * (1 - p)) if logistic else (margin - y, np.ones(400))
        want = plain_tree(x, g, h, borders, 3, 0.3, 2.0, 3.0)
        assert {k: (n.feature, n.bin, round(n.gain, 6)) for k, n in tree.items() if n.feature is not None} == {k: v for k, v in want.items() if v[0] is not None}
        assert {k: pytest.approx(v[1]) for k, v in want.items() if v[0] is None} == {k: n.value for k, n in tree.items() if n.feature is None}
        one = trees.Trees(model.features, 0.0, False, [tree])
        margin = margin + np.array([r[0] for r in df.select(trees.margins(one)).collect()])
    scores = [r.score for r in trees.score_table(model, df.withColumn("id", F.monotonically_increasing_id()), "id", "y").collect()]
    assert np.allclose(scores, 1 / (1 + np.exp(-margin)) if logistic else margin)


def test_trees_of_odd_tables(spark):
    df = spark.createDataFrame([(1.0, None, 1), (1.0, None, 0), (None, None, None)], "a double, b double, y int")
    model = trees.fit(df, ["a", "b"], "y", trees=1, depth=2)
    assert [n.feature for n in model.trees[0].values()] == [None]
    assert trees.fit(df.limit(0), ["a"], "y", trees=2).trees == [{0: trees.Node()}] * 2
    with pytest.raises(ValueError):
        trees.fit(df, [], "y")


# ---- pairs of files


def paired(spark, paths, *patterns, **options):
    found = link.pair_files(spark.createDataFrame([(p,) for p in paths], "path string"), *patterns, **options)
    return sorted((r.id, r.input_path, r.target_path) for r in found.collect())


def test_file_patterns(spark):
    paths = ["/d/case_1/case_1_flair.png", "/d/case_1/case_1_seg.png", "/d/case_1/old_flair.png", "/d/case_1/old_seg.png", "/d/other/other_flair.png", "/d/other/other_seg.png", "/d/case_1/x/case_1_flair.png"]
    assert paired(spark, paths, "case_*", "*_flair.png", "*_seg.png") == [("case_1_flair.png", paths[0], paths[1])]
    assert [p[0] for p in paired(spark, paths, "case_?", "{id}_flair.png", "{id}_seg.png")] == ["case_1", "old"]
    assert paired(spark, paths, "[!a-n]*", "*_flair.png", "*_seg.png") == [("other_flair.png", paths[4], paths[5])]
    odd = ["/r/a.b+c/a.b+c_in_1(2).png", "/r/a.b+c/a.b+c_out_1(2).png", "/r/aXb+c/a.b+c_in_1(2).png", "/r/a.b+c/a.b+c_out_1[2].png", "/r/a.b+c/aXb+c_in_9.png", "/r/a.b+c/aXb+c_out_9.png"]
    assert paired(spark, odd, "*", "*_in_{id}.png", "*_out_{id}.png") == [("1(2)", odd[0], odd[1])]
    slices = ["/v/p1/p1_flair_7.png", "/v/p1/p1_seg_7.png", "/v/p1/p1_flair_77.png"]
    assert paired(spark, slices, "*", "*_flair_?.png", "*_seg_{id}.png", remove_prefix="p1_flair_", remove_suffix=".png") == [("7", slices[0], slices[1])]
    assert paired(spark, slices, "v/p*", "*_flair_{id}.png", "*_seg_{id}.png") == [("7", slices[0], slices[1])]
    assert paired(spark, [], "*", "{id}.a", "{id}.b") == []


# ---- curves


def test_corners_of_a_curve(spark):
    rng = random.Random(5)
    for rows in ([(rng.randint(0, 1), rng.randint(0, 60) / 60) for _ in range(300)], [(1, 0.5)] * 3, [(k % 2, k / 40) for k in range(40)], [(1, k / 9) for k in range(9)] + [(0, -k / 9) for k in range(1, 9)]):
        df = spark.createDataFrame(rows, "label int, score double")
        scores = sorted({s for _, s in rows}, reverse=True)
        steps = [(sum(y for y, s in rows if s == t), sum(1 - y for y, s in rows if s == t)) for t in scores]
        stay = [t for k, t in enumerate(scores) if k + 1 == len(scores) or steps[k] != steps[k + 1]]
        got = metrics.roc_curve(df, drop_collinear=True)
        assert sorted((r.threshold for r in got.collect()), reverse=True) == [float("inf"), *stay]
        every = {r.threshold: (r.fpr, r.tpr) for r in metrics.roc_curve(df).collect()}
        assert all(every[r.threshold] == (r.fpr, r.tpr) for r in got.collect())
        assert "SinglePartition" not in metrics.corners(df)._jdf.queryExecution().executedPlan().toString()


def test_all_default_metrics_in_six_jobs(spark):
    rng = random.Random(8)
    rows = [(y, min(1.0, max(0.0, y * 0.3 + rng.random() * 0.7))) for y in (rng.randint(0, 1) for _ in range(2000))]
    df = spark.createDataFrame(rows, "label int, score double").withColumn("pred", metrics.predict_label(F.col("score")))
    spark.sparkContext.setJobGroup("evaluate", "count jobs")
    found = metrics.evaluate(df, [*metrics.default_metrics("binary"), "mse", "mae", "rmse", "r2_score"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("evaluate")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = {r.metric: r.value for r in found.collect()}
    assert len(jobs) <= 6
    regression, report = metrics.regression(df).first(), {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert got["roc_auc"] == pytest.approx(metrics.roc_auc(df).first()[0]) and got["mse"] == pytest.approx(regression.mse) and got["r2_score"] == pytest.approx(regression.r2_score)
    assert len(report) == 5 and all(got[f"classification_report.{name}.{c}"] == pytest.approx(r[c]) for name, r in report.items() for c in ("precision", "recall", "f1", "support"))


# ---- hot links


def test_a_hot_key_is_dealt_out(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10).alias("k"), F.col("id").alias("a"), F.lit("x").alias("__i"))
    right = spark.range(900).select(F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") + 9).alias("k"), F.col("id").alias("b"))
    left = left.drop("__i").unionByName(left.limit(2).drop("__i")).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 7L AS a"))
    want = sorted(map(tuple, left.join(right, "k").collect()))
    dealt = link.link_dealt(left, right, "k", pairs_a_task=10_000)
    assert sorted(map(tuple, dealt.collect())) == want
    assert tuple(link.hot_keys(left, right, "k", 10_000).first()) == (1, 11, 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = [r["count"] for r in link.link_dealt(left, right, "k", pairs_a_task=10_000).filter("k = 1").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(blocks) == 4 and max(blocks) < sum(blocks) / 2


def test_copies_of_a_dealt_key_grow_with_its_rows(spark):
    """Blocks of one row would copy every row for each of its partners; block pairs are bounded over all hot keys, and the join stays whole."""
    both = lambda n, name: spark.range(n).select((F.col("id") % 3).alias("k"), F.col("id").alias(name))
    for times in (1, 4):
        left, right = both(900 * times, "a"), both(300 * times, "b")
        hot = link.hot_keys(left, right, "k", 1).collect()
        copies = sum(300 * times * h.right_blocks + 100 * times * h.left_blocks for h in hot)
        assert len(hot) == 3 and copies <= 1200 * times * (1 + link.BLOCK_PAIRS**0.5) and sum(h.left_blocks * h.right_blocks for h in hot) < 1.5 * link.BLOCK_PAIRS
    want = sorted(map(tuple, left.join(right, "k").filter("a < 30").collect()))
    assert sorted(map(tuple, link.link_dealt(left, right, "k", 1).filter("a < 30").collect())) == want
    assert link.link_dealt(left, right, "k", 1).count() == 3 * 1200 * 400


# ---- distances


@pytest.mark.parametrize("shape", [(7,), (9, 14), (1, 6), (5, 6, 7), (3, 1, 4, 5)])
def test_distance_transform_equals_all_pairs(shape):
    rng = np.random.default_rng(sum(shape))
    for share in (0.03, 0.3, 0.9):
        mask = rng.random(shape) < share
        mask.flat[rng.integers(mask.size)] = True
        cells, points = np.argwhere(np.ones(shape, dtype=bool)), np.argwhere(mask)
        want = ((cells[:, None] - points[None]) ** 2).sum(-1).min(1).reshape(shape)
        assert (metrics.nearest_squared(mask) == want).all()


def test_a_large_mask(spark):
    mask = np.zeros((2000, 2000), dtype=bool)
    mask[5, 7] = mask[1990, 1500] = True
    far = metrics.nearest_squared(mask)
    assert far[0, 0] == 74 and far[1999, 1999] == 81 + 499**2 and metrics.mask_distance(mask, ~mask) == pytest.approx(far.max() ** 0.5)
    volume = [(1, [1.0] + [0.0] * 26, [0.0] * 26 + [1.0], [3, 3, 3])]
    got = metrics.hausdorff_each(spark.createDataFrame(volume, "image_id long, pred array<double>, truth array<double>, shape array<int>")).first()
    assert got.distance == pytest.approx(12**0.5)


# ---- the guard

REFLECT = "reflect('java.lang.System', 'getProperty', 'user.home')"
WIDE = ", ".join(f"k + {j} AS c{j}" for j in range(30))


@pytest.mark.parametrize("query", [
    f"SELECT {WIDE}, {REFLECT} AS x FROM o", f"SELECT named_struct('a', {REFLECT}) AS s FROM o", f"SELECT transform(arr, v -> concat(v, {REFLECT})) AS t FROM o", f"WITH q AS (SELECT {REFLECT} AS x) SELECT * FROM o JOIN q ON v = x",
    f"SELECT * FROM o WHERE v IN (SELECT {REFLECT} FROM c)", "SELECT try_reflect('java.lang.System', 'getProperty', 'user.home') AS x FROM o", f"SELECT nvl(v, {REFLECT}) AS x FROM o", f"SELECT startswith({REFLECT}, '/') AS x FROM o",
    f"SELECT k, sum(k) OVER (PARTITION BY {REFLECT} ORDER BY k) AS w FROM o", f"SELECT {WIDE}, (SELECT count(*) FROM parquet.`{{path}}`) AS n FROM o", "SELECT input_file_name() AS f FROM o", f"SELECT * FROM o ORDER BY {REFLECT}", "SELECT own_function(k) AS x FROM o",
])
def test_what_no_query_may_hold(spark, tmp_path, query):
    spark.createDataFrame([(9,)], "k int").write.parquet(str(tmp_path / "secret"))
    spark.udf.register("own_function", lambda k: k, "long")
    o = spark.range(5).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"), F.array(F.lit("a")).alias("arr"))
    with pytest.raises(ValueError, match="may not call|may read"):
        link.link_tables(spark, {"o": o, "c": o.select(F.col("k").alias("j"), "v")}, query.replace("{path}", str(tmp_path / "secret")))


@pytest.mark.parametrize("query", [
    "SELECT * FROM o JOIN c ON k = j", "SELECT v, count(*) AS n, collect_list(w) AS l FROM o LEFT JOIN c ON k = j GROUP BY ROLLUP(v)", "SELECT *, row_number() OVER (PARTITION BY v ORDER BY k) AS r, nvl(v, 'a') AS z, left(v, 1) AS l, transform(arr, x -> upper(x)) AS t FROM o",
    "SELECT * FROM o WHERE k IN (SELECT j FROM c) AND EXISTS (SELECT 1 FROM c WHERE j = k)", "SELECT v FROM o UNION SELECT w FROM c", "SELECT k, x FROM o LATERAL VIEW explode(arr) t AS x", "SELECT * FROM (SELECT v, k FROM o) PIVOT (sum(k) FOR v IN ('0' AS a, '1' AS b))",
    "SELECT sha2(v, 256) AS s, to_timestamp('2020-01-01') AS t, luhn_check(v) AS lc, url_encode(v) AS u, try_divide(k, 0) AS d, percentile_approx(k, 0.5) OVER () AS p FROM o LIMIT 4", "SELECT * FROM VALUES (1L, 'a'), (2L, 'b') AS x(i, s) JOIN o ON i = k",
])
def test_what_queries_may_hold(spark, query):
    o = spark.range(5).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"), F.array(F.lit("a")).alias("arr"))
    assert link.link_tables(spark, {"o": o, "c": o.select(F.col("k").alias("j"), F.col("v").alias("w"))}, query).count() > 0
