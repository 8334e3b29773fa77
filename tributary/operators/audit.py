"""Privacy budgets and policy checks over tables of contracts and runs.

contracts: id, datasets array<struct<id, owner, endpoint, kid>>, privacy array<struct<dataset, epsilon_threshold, delta>> (texts).
runs: id, contract_id, mounts array<struct<mount_point, read_write, endpoint, kid>>,
pipeline array<struct<name, is_private, epsilon, delta>>. read_contracts and read_runs make these from the nested documents as they are written.

The three checks of a run look at its contract's and its own arrays only, so a run is joined with its contract once, and
each check is an expression over the joined row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOUNT_ROOT = "/mnt/remote/"
CONTRACT_SCHEMA = """id string,
    datasets array<struct<id: string, name: string, owner: string, url: string, provider: string, key: struct<type: string, properties: struct<kid: string, endpoint: string, authority: struct<endpoint: string>>>>>,
    constraints array<struct<privacy: array<struct<dataset: string, epsilon_threshold: string, delta: string>>>>"""
RUN_SCHEMA = """id string, contract_id string,
    pipeline array<struct<name: string, config: struct<is_private: boolean, privacy_params: struct<epsilon: double, delta: double>>>>,
    azure_filesystems array<struct<mount_point: string, read_write: boolean, key: struct<kid: string, akv: struct<endpoint: string>>>>"""


def contracts_of(documents: DataFrame) -> DataFrame:
    """contracts from documents of CONTRACT_SCHEMA: the key's properties and the constraints' privacy entries, each brought to the top."""
    dataset = lambda d: F.struct(d["id"].alias("id"), d["owner"].alias("owner"), d["key"]["properties"]["endpoint"].alias("endpoint"), d["key"]["properties"]["kid"].alias("kid"))
    privacy = F.flatten(F.filter(F.transform("constraints", lambda c: c["privacy"]), lambda p: p.isNotNull()))
    return documents.select("id", F.transform("datasets", dataset).alias("datasets"), privacy.alias("privacy"))


def runs_of(documents: DataFrame) -> DataFrame:
    """runs from documents of RUN_SCHEMA."""
    mount = lambda m: F.struct(m["mount_point"].alias("mount_point"), m["read_write"].alias("read_write"), m["key"]["akv"]["endpoint"].alias("endpoint"), m["key"]["kid"].alias("kid"))
    stage = lambda s: F.struct(
        s["name"].alias("name"), s["config"]["is_private"].alias("is_private"), s["config"]["privacy_params"]["epsilon"].alias("epsilon"), s["config"]["privacy_params"]["delta"].alias("delta"),
    )
    return documents.select("id", "contract_id", F.transform("azure_filesystems", mount).alias("mounts"), F.transform("pipeline", stage).alias("pipeline"))


def read_contracts(spark: SparkSession, path: str) -> DataFrame:
    """contracts from JSON files, one document or a list of them in each."""
    return contracts_of(spark.read.schema(CONTRACT_SCHEMA).option("multiLine", True).json(path))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """runs from JSON files, one document or a list of them in each."""
    return runs_of(spark.read.schema(RUN_SCHEMA).option("multiLine", True).json(path))


def contract_explode(contracts: DataFrame) -> DataFrame:
    """id, dataset, epsilon, delta: one row per privacy constraint; numbers are given as texts."""
    return contracts.select("id", F.explode("privacy").alias("p")).select(
        "id", F.col("p.dataset").alias("dataset"), F.expr("try_cast(p.epsilon_threshold AS double)").alias("epsilon"), F.expr("try_cast(p.delta AS double)").alias("delta")
    )


def min_privacy_budget(contracts: DataFrame) -> DataFrame:
    """id, epsilon, delta, mechanism: the least over a contract's datasets; gaussian if any delta is set, else laplace."""
    rows = contract_explode(contracts).groupBy("id").agg(F.min("epsilon").alias("epsilon"), F.min("delta").alias("delta"))
    return rows.withColumn("mechanism", F.when(F.col("delta").isNotNull(), "gaussian").otherwise("laplace"))


def epsilon_per_tree(epsilon: Column, trees: Column) -> Column:
    return epsilon / trees


def epsilon_spent(epsilon: Column, trees: Column, subsample: Column) -> Column:
    """trees * ln(1 + subsample * (e^(epsilon / trees) - 1))."""
    return trees * F.log1p(subsample * F.expm1(epsilon_per_tree(epsilon, trees)))


def delta_clamp(delta: Column, n_train: Column) -> Column:
    return F.least(delta, 1.0 / n_train)


def audited(contracts: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs joined with their contract, once: run_id, id (of the contract, null if there is none), datasets, privacy, mounts, pipeline."""
    mine = runs.select(F.col("id").alias("run_id"), F.col("contract_id").alias("id"), "mounts", "pipeline")
    return mine.join(contracts.select("id", "datasets", "privacy", F.lit(True).alias("found")), "id", "left")


def _covers(dataset: Column, mount: Column) -> Column:
    """Whether a mount is a read-only one of the data set, with its endpoint and key, below its owner's folder."""
    same = (mount["mount_point"] == F.concat(F.lit(MOUNT_ROOT), dataset["owner"])) & (mount["endpoint"] == dataset["endpoint"]) & (mount["kid"] == dataset["kid"])
    return F.coalesce(same & ~mount["read_write"], F.lit(False))


def _uncovered() -> Column:
    mounts = F.coalesce("mounts", F.array())
    return F.filter(F.coalesce("datasets", F.array()), lambda d: ~F.exists(mounts, lambda m: _covers(d, m)))


def _providers() -> Column:
    return F.size(F.array_distinct(F.transform(F.coalesce("datasets", F.array()), lambda d: d["owner"])))


def _mounts() -> Column:
    return F.size(F.coalesce("mounts", F.array()))


def _mounts_ok() -> Column:
    return _mounts().between(_providers() + 1, _providers() + 2)


def _threshold() -> Column:
    """The least epsilon over the contract's privacy entries, whose numbers are texts."""
    return F.array_min(F.transform("privacy", lambda p: p["epsilon_threshold"].try_cast("double")))


def _budget_ok() -> Column:
    last = F.try_element_at("pipeline", F.lit(-1))
    within = last["is_private"] & (last["epsilon"] <= _threshold())
    return F.when(_threshold().isNotNull(), F.coalesce(within, F.lit(False))).otherwise(F.coalesce(~last["is_private"], F.lit(False)))


def dataset_coverage(contracts: DataFrame, runs: DataFrame) -> DataFrame:
    """run_id, dataset: contract datasets without a read-only mount of the same endpoint and key below the owner's folder."""
    return audited(contracts, runs).select("run_id", F.explode(_uncovered()).alias("d")).select("run_id", F.col("d.id").alias("dataset"))


def mount_count_check(contracts: DataFrame, runs: DataFrame) -> DataFrame:
    """run_id, providers, mounts, ok: between providers + 1 and providers + 2 mounts; runs whose contract exists."""
    return audited(contracts, runs).filter("found").select("run_id", _providers().alias("providers"), _mounts().alias("mounts"), _mounts_ok().alias("ok"))


def budget_gate(contracts: DataFrame, runs: DataFrame) -> DataFrame:
    """run_id, epsilon, threshold, ok: with privacy constraints the last stage must be private within the least threshold, else explicitly not private."""
    return audited(contracts, runs).select("run_id", F.try_element_at("pipeline", F.lit(-1))["epsilon"].alias("epsilon"), _threshold().alias("threshold"), _budget_ok().alias("ok"))


def contract_audit(contracts: DataFrame, runs: DataFrame) -> DataFrame:
    """run_id, covered, mounts_ok, budget_ok, allowed: one row per run whose contract exists."""
    checks = audited(contracts, runs).filter("found").select("run_id", (F.size(_uncovered()) == 0).alias("covered"), _mounts_ok().alias("mounts_ok"), _budget_ok().alias("budget_ok"))
    return checks.withColumn("allowed", F.col("covered") & F.col("mounts_ok") & F.col("budget_ok"))
