"""Rules of the second round: guards, nested contracts, metrics that fail, exact ranks and splits at any size, files in ranges."""

import json
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.operators import audit, encode, link, metrics, missing, rank, scale, split
from tributary.plans import lineage
from tributary.sources import tables


@pytest.fixture(scope="module")
def sides(spark):
    return {"a": spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), "b": spark.createDataFrame([(1, 5), (2, 6)], "k int, w int")}


@pytest.mark.parametrize("query, what", [
    ("SELECT reflect('java.lang.System', 'getProperty', 'user.home') AS x FROM a", "JVM"),
    ("SELECT `reflect`('java.lang.System', 'getProperty', 'user.home') AS x FROM a", "JVM"),
    ("SELECT * FROM a WHERE v = (SELECT java_method('java.lang.System', 'getProperty', 'user.home'))", "JVM"),
    ("SELECT * FROM parquet.`{path}`", "own run"), ("SELECT * FROM a WHERE k IN (SELECT k FROM parquet.`{path}`)", "own run"), ("SELECT * FROM other_table", "own run"),
    ("SELECT * FROM a, b WHERE a.k + b.w > 0", "equality"), ("SELECT * FROM a CROSS JOIN b", "equality"), ("SELECT * FROM a LEFT JOIN b ON a.k < b.k", "equality"),
])
def test_refused_queries(spark, sides, tmp_path, query, what):
    spark.createDataFrame([(9,)], "k int").write.parquet(str(tmp_path / "secret"))
    spark.createDataFrame([(9,)], "k int").createOrReplaceTempView("other_table")
    with pytest.raises(ValueError, match=what):
        link.link_tables(spark, sides, query.format(path=tmp_path / "secret"))
    spark.catalog.dropTempView("other_table")


def test_allowed_queries(spark, sides):
    run = lambda q, **k: sorted(map(tuple, link.link_tables(spark, sides, q, **k).collect()))
    assert run("WITH RECURSIVE s(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM s WHERE n < 4) SELECT n, v FROM s JOIN a ON a.k = s.n") == [(1, "x"), (2, "y")]
    assert run("WITH big AS (SELECT * FROM b WHERE w > 5) SELECT a.v, big.w FROM a JOIN big ON a.k = big.k") == [("y", 6)]
    assert run("SELECT v FROM a WHERE k IN (SELECT k FROM b)") == [("x",), ("y",)]


def test_missing_keys_are_left_out_of_a_link(spark):
    from tributary.operators.deidentify import pseudonymise

    one, two = (pseudonymise(spark.createDataFrame([(1, "p"), (None, "q"), (None, "r")], f"k long, {c} string"), ["k"]) for c in ("x", "y"))
    query = "SELECT * FROM one JOIN two ON one.k_hashed = two.k_hashed"
    assert link.link_tables(spark, {"one": one, "two": two}, query).count() == 5
    assert link.link_tables(spark, {"one": one, "two": two}, query, without_missing=["k_hashed"]).count() == 1


def test_contracts_as_they_are_written(spark, tmp_path):
    dataset = lambda i, owner: {
        "id": i, "name": "n", "owner": owner, "url": "u", "provider": "p", "key": {"type": "t", "properties": {"kid": f"k{i}", "authority": {"endpoint": "maa"}, "endpoint": "hsm"}},
    }
    contract = {"id": "c1", "datasets": [dataset("1", "a"), dataset("2", "b")], "constraints": [{"privacy": [{"dataset": "1", "epsilon_threshold": "7.5", "delta": "0.01"}]}, {"privacy": [{"dataset": "2", "epsilon_threshold": "4.0", "delta": None}]}]}
    free = {"id": "c2", "datasets": [dataset("1", "a")], "constraints": None}
    mount = lambda i, owner, write=False: {"mount_point": f"/mnt/remote/{owner}", "read_write": write, "key": {"kid": f"k{i}", "akv": {"endpoint": "hsm"}}}
    stage = lambda private, epsilon=None: {"name": "s", "config": {"is_private": private, "privacy_params": {"epsilon": epsilon, "delta": 0.01}}}
    both = [mount("1", "a"), mount("2", "b"), mount("9", "out", True)]
    runs = [
        ("ok", "c1", both, [stage(False), stage(True, 4.0)]), ("over", "c1", both, [stage(True, 7.0)]), ("order", "c1", both, [stage(True, 1.0), stage(False)]),
        ("missing", "c1", [*both[1:], mount("9", "x")], [stage(True, 1.0)]), ("writable", "c1", [mount("1", "a", True), *both[1:]], [stage(True, 1.0)]),
        ("few", "c1", both[:2], [stage(True, 1.0)]), ("public", "c2", [both[0], both[2]], [stage(False)]), ("untold", "c2", [both[0], both[2]], []), ("lost", "c3", both, [stage(False)]),
    ]
    (tmp_path / "contracts.json").write_text(json.dumps([contract, free]))
    (tmp_path / "runs.json").write_text(json.dumps([{"id": i, "contract_id": c, "azure_filesystems": m, "pipeline": p} for i, c, m, p in runs]))
    contracts, table = audit.read_contracts(spark, str(tmp_path / "contracts.json")), audit.read_runs(spark, str(tmp_path / "runs.json"))
    got = {r.run_id: (r.covered, r.mounts_ok, r.budget_ok, r.allowed) for r in audit.contract_audit(contracts, table).collect()}
    assert got == {
        "ok": (True, True, True, True), "over": (True, True, False, False), "order": (True, True, False, False), "missing": (False, True, True, False), "writable": (False, True, True, False),
        "few": (True, False, True, False), "public": (True, True, True, True), "untold": (True, True, False, False),
    }
    assert sorted(map(tuple, audit.contract_explode(contracts).collect())) == [("c1", "1", 7.5, 0.01), ("c1", "2", 4.0, None)]
    plan = audit.contract_audit(contracts, table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and plan.count("Join") == 1


def test_evaluate_reports_params_and_failures(spark):
    df = spark.createDataFrame([(0, 0, 0.2), (1, 0, 0.4), (1, 1, 0.9), (0, 0, 0.1)], "label int, pred int, score double")
    got = {r.metric: (r.value, r.note) for r in metrics.evaluate(df, metrics.default_metrics("binary")).collect()}
    assert got["roc_auc"] == (1.0, None) and got["classification_report.1.recall"] == (0.5, None) and got["classification_report.accuracy.precision"][0] == 0.75
    asked = [{"name": "precision", "params": {"average": "micro"}}, "recall", {"name": "f1_score", "params": {"average": "none"}}, "roc_curve", "made_up"]
    got = {r.metric: (r.value, r.note) for r in metrics.evaluate(df, asked).collect()}
    assert got["precision"] == (0.75, None) and got["recall"] == (0.5, None)
    assert got["f1_score"][0] is None and got["roc_curve"][1] == "a table, see evaluation_tables" and got["made_up"][1] == "unknown metric"
    words = df.withColumn("label", F.lit("no number"))
    got = {r.metric: (r.value, r.note) for r in metrics.evaluate(words, ["mse", "accuracy"]).collect()}
    assert got["mse"][0] is None and got["mse"][1]
    masks = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 1.0], [1.0, 0.0, 0.0, 0.0], 2)], "image_id long, pred array<double>, truth array<double>, width int")
    got = {r.metric: r.value for r in metrics.evaluate(masks, [*metrics.default_metrics("segmentation"), "hausdorff_distance"]).collect()}
    assert got == {"dice_score": pytest.approx(2 / 3, abs=1e-5), "jaccard_index": 0.5, "hausdorff_distance": pytest.approx(2**0.5)}
    assert set(metrics.evaluation_tables(df, ["roc_curve", "confusion_matrix", "mse"])) == {"roc_curve", "confusion_matrix"}


def test_one_against_one(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 2), [rng.randint(0, 5) / 5 for _ in range(3)]) for _ in range(90)]
    wanted = []
    for a in range(3):
        for b in range(3):
            pos, neg = [s[a] for y, s in rows if y == a], [s[a] for y, s in rows if y == b]
            if a != b:
                wanted.append(sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg)))
    df = spark.createDataFrame(rows, "label int, scores array<double>")
    assert metrics.roc_auc_multiclass(df, "ovo").first()[0] == pytest.approx(sum(wanted) / len(wanted))


def test_a_grid_of_too_many_classes_is_an_error(spark):
    df = spark.range(30).select(F.col("id").alias("label"), F.col("id").alias("pred"))
    with pytest.raises(ValueError, match="confusion_pairs"):
        metrics.confusion_matrix(df, 20)
    assert metrics.confusion_pairs(df).count() == 30 and metrics.confusion_matrix(df, 30).count() == 900


def test_hausdorff_of_large_masks(spark):
    side = 60
    one, two = np.ones((side, side)), np.zeros((side, side))
    two[0, 0] = 1
    df = spark.createDataFrame([(1, one.ravel().tolist(), two.ravel().tolist(), side)], "image_id long, pred array<double>, truth array<double>, width int")
    assert metrics.hausdorff_each(df).first().distance == pytest.approx((2 * (side - 1) ** 2) ** 0.5)


@pytest.mark.parametrize("parts", ["3", "70"])
def test_ranks_need_no_saved_rows(spark, parts):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rng = random.Random(4)
        rows = [(i, rng.choice([None, *range(9)]), rng.choice(["ä", "b", "", None]), rng.choice([None, 1.0])) for i in range(700)]
        df = spark.createDataFrame(rows, "id int, v int, s string, x double")
        order = [F.col("v"), F.col("s"), F.col("id")]
        ranked = rank.global_rank(df, order)
        none_first = lambda x: (x is not None, x if x is not None else 0)
        text_first = lambda x: (x is not None, (x or "").encode())
        want = sorted(rows, key=lambda r: (none_first(r[1]), text_first(r[2]), r[0]))
        assert [r.id for r in sorted(ranked.collect(), key=lambda r: r.rank)] == [r[0] for r in want]
        assert "Scan ExistingRDD" in ranked._jdf.queryExecution().executedPlan().toString() and "checkpoint" not in ranked._jdf.queryExecution().toString()
        filled = {r.id: r.x for r in missing.missing_ffill(df, order, ["x"]).collect()}
        last = None
        for r in want:
            last = last if r[3] is None else r[3]
            assert filled[r[0]] == last
        assert rank.global_rank(df.limit(0), order).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_splits_of_many_classes_equal_those_of_few(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 97).alias("y"))
    one = {tuple(r) for r in split.split_stratified(df, ["id"], "y", (0.7, 0.2, 0.1)).collect()}
    many = {tuple(r) for r in split.split_stratified(df, ["id"], "y", (0.7, 0.2, 0.1), max_collected=1).collect()}
    assert one == many and len(one) == 3000
    assert split.digits_for(1) == 1 and split.digits_for(10**9) == 4 and split.digits_for(10**13) == split.MOST_DIGITS


def test_exact_quartiles_by_rank(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(20)]), rng.random(), None, 3.0) for _ in range(501)]
    df = spark.createDataFrame(rows, "a int, b double, c double, d double")
    got = scale.quartiles(df, ["a", "b", "c", "d"])
    for column, q in zip(range(4), got, strict=True):
        values = [r[column] for r in rows if r[column] is not None]
        assert q is None if not values else q == pytest.approx(np.percentile(values, [25, 50, 75]).tolist())
    assert scale.scale(df, ["c", "d"], "robust").agg(F.max("d")).first()[0] == 0.0


def test_a_column_of_1500_categories_stays_one_hot(spark):
    df = spark.range(150_000).select((F.col("id") % 1500).cast("string").alias("k"), F.col("id"))
    assert encode.encoding_plan(df, ["k"]).first().kind == "one_hot_sparse"
    assert encode.encoding_plan(df, ["k"], max_wide=2000).first().kind == "one_hot"
    small = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "k string")
    fitted = encode.fitted_encoding(small.filter("k <> 'c' OR k IS NULL"), {"k": "one_hot_sparse"})
    matrix, features = encode.build_matrix(small, {"k": "one_hot_sparse"}, [], [], fitted)
    assert features == ["k_hot"] and sorted(r.k_hot for r in matrix.collect()) == [-1, -1, 0, 1]


def test_safetensors_in_ranges(spark, tmp_path):
    x, y = np.arange(1000 * 4, dtype="<f2").reshape(1000, 2, 2), np.arange(1000, dtype="<i4")
    header = json.dumps({"features": {"dtype": "F16", "shape": [1000, 2, 2], "data_offsets": [0, x.nbytes]}, "targets": {"dtype": "I32", "shape": [1000], "data_offsets": [x.nbytes, x.nbytes + y.nbytes]}}).encode()
    (tmp_path / "x.safetensors").write_bytes(struct.pack("<Q", len(header)) + header + x.tobytes() + y.tobytes())
    df = tables.read_safetensors(spark, str(tmp_path), range_bytes=800)
    rows = df.orderBy("row").collect()
    assert [r.target for r in rows] == list(range(1000)) and rows[7].features == x[7].ravel().tolist() and rows[0].shape == [2, 2]


def test_scores_equal_the_sum_of_the_trees(spark):
    from pyspark.ml.linalg import Vectors

    from tributary.operators import model

    rng = random.Random(11)
    rows = [(i, rng.random(), rng.random()) for i in range(300)]
    df = spark.createDataFrame([(i, a, b, int(a + b + rng.gauss(0, 0.2) > 1)) for i, a, b in rows], "key long, a double, b double, y int")
    fitted = model.gbt_baseline(df.filter("key % 3 > 0"), ["a", "b"], "y", trees=4, depth=2)
    table = model.score_table(fitted, df.filter("key % 3 = 0"), ["a", "b"], "key", "y").collect()
    truth = {r.key: r for r in df.collect()}
    assert sorted(r.id for r in table) == [i for i, *_ in rows if i % 3 == 0]
    for r in table:
        margin = sum(w * t.predict(Vectors.dense(truth[r.id].a, truth[r.id].b)) for w, t in zip(fitted.treeWeights, fitted.trees, strict=True))
        assert r.label == truth[r.id].y and r.score == pytest.approx(1 / (1 + np.exp(-2 * margin)))


def test_training_rows_come_in_parts_of_bounded_size(spark, monkeypatch):
    from tributary.operators import model

    seen = []
    monkeypatch.setattr(model, "CELLS_A_PART", 3000, raising=False)
    monkeypatch.setattr(model.GBTClassifier, "fit", lambda self, df: seen.append([len(p) for p in df.select("__label").rdd.glom().collect()]))
    rows = lambda n, parts: spark.range(0, n, 1, parts).select(F.col("id").cast("double").alias("a"), F.rand(1).alias("b"), (F.col("id") % 2).alias("y"))
    for df in (rows(6000, 1), rows(6000, 1).union(rows(0, 40)), rows(1200, 4)):
        model.gbt_baseline(df, ["a", "b"], "y")
    assert all(sum(sizes) == 6000 and len(sizes) == 12 and max(sizes) <= 510 for sizes in seen[:2])
    assert seen[2] == [300] * 4


def test_settings_of_the_session_stay(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n3\n")
    before = spark.conf.get("spark.sql.csv.parser.columnPruning.enabled")
    assert tables.read_csv(spark, str(tmp_path / "x.csv")).count() == 1
    assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == before


def test_no_folder_of_our_own_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, other=None: other)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lineage.shared_folder(Session())
