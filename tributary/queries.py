"""Queries over the driver's tables, one for each operator, with the same question as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import columns as c
from tributary.functions.images import image_tensor as tensor_of
from tributary.operators import aggregate, audit, deidentify, encode, files, link, losses, metrics, missing, model, scale, split, trees, vectors
from tributary.plans.lineage import new_folder
from tributary.sources import folders, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


#: Added before rounding to 4 digits on both sides, so that exact ties don't hang on the last bit of a sum.
NUDGE = 1e-7


def query(sql: str | None = None, name: str | None = None):
    """Register a function (t, spark) -> DataFrame, where t(name) is a table, with its SQL."""

    def register(f):
        key = name or f.__name__
        QUERIES[key] = lambda spark, sf_dir: f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"), spark)
        if sql:
            ORACLE_SQL[key] = sql.replace(", 4) AS", f" + {NUDGE}, 4) AS")
        return f

    return register


def r(column: Column | str, digits: int = 4) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column + NUDGE if digits == 4 else column, digits)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(*[r(F.col(k), digits).alias(k) if t in ("double", "float") else F.col(k) for k, t in df.dtypes])


# ---- sources and sinks


def _written(df: DataFrame, spark: SparkSession, suffix: str, write) -> str:
    path = f"{new_folder(spark, 'tables')}/table.{suffix}"
    write(df, path)
    return path


@query("SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 2) AS c_acctbal, c_mktsegment FROM customer")
def read_csv(t, spark):
    path = _written(t("customer"), spark, "csv", tables.write_csv)
    return tables.read_csv(spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").withColumn("c_acctbal", r("c_acctbal", 2))


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def read_parquet(t, spark):
    return tables.read_parquet(spark, _written(t("supplier"), spark, "parquet", tables.write_parquet)).select("s_suppkey", "s_name", "s_nationkey")


@query("SELECT o_orderpriority, count(*) AS n, sum(o_custkey)::BIGINT AS keys FROM orders GROUP BY 1")
def read_by_format(t, spark):
    path = _written(t("orders").select("o_orderkey", "o_custkey", "o_orderpriority"), spark, "csv", tables.write_csv)
    return tables.read_by_format(spark, path).groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum(F.col("o_custkey").cast("long")).alias("keys"))


@query("""SELECT label AS target, count(*) AS n, round(sum(list_sum(list_transform(embedding, lambda x: x::DOUBLE))), 3) AS total,
    max(len(embedding))::INTEGER AS width FROM embeddings GROUP BY 1""")
def read_feature_target(t, spark):
    path = _written(t("embeddings"), spark, "parquet", tables.write_parquet)
    pairs = tables.read_feature_target(spark, path, "embedding", "label")
    own = F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return pairs.groupBy("target").agg(F.count("*").alias("n"), r(F.sum(own), 3).alias("total"), F.max(F.size("features")).alias("width"))


@query("SELECT 'rows' AS metric, count(*)::DOUBLE AS value FROM orders UNION ALL SELECT 'customers', count(DISTINCT o_custkey)::DOUBLE FROM orders")
def write_metrics_json(t, spark):
    o = t("orders")
    long = o.agg(F.lit("rows").alias("metric"), F.count("*").cast("double").alias("value")).unionByName(o.agg(F.lit("customers").alias("metric"),
        F.countDistinct("o_custkey").cast("double").alias("value")))
    path = _written(long, spark, "json", tables.write_metrics_json)
    return spark.read.schema("metric string, value double").json(path)


# ---- names, keys, columns

KEYS = {"c_custkey": "pk_mobno", "c_nationkey": "ref_nation"}


@query("SELECT c_custkey AS pk_mobno, c_name, c_nationkey AS ref_nation FROM customer")
def rename_keys(t, spark):
    return deidentify.rename_keys(t("customer").select("c_custkey", "c_name", "c_nationkey"), KEYS | {"absent": "x"})


@query("SELECT c_custkey, c_name AS cust_c_name, c_mktsegment AS cust_c_mktsegment FROM customer")
def prefix_columns(t, spark):
    return deidentify.prefix_columns(t("customer").select("c_custkey", "c_name", "c_mktsegment"), "cust", ["c_custkey"])


@query("SELECT sha256(coalesce(nullif(c_nationkey, 3)::VARCHAR, '')) AS key_hashed, c_custkey FROM customer")
def pseudonymise(t, spark):
    return deidentify.pseudonymise(t("customer").select(F.nullif("c_nationkey", F.lit(3)).alias("key"), "c_custkey"), ["key"], {"key": "long"})


@query("""SELECT c_name AS cust_c_name, c_mktsegment AS cust_c_mktsegment, sha256(c_custkey::VARCHAR) AS pk_mobno_hashed, sha256(c_nationkey::VARCHAR) AS ref_nation_hashed
    FROM customer""")
def standardise_provider(t, spark):
    df = t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return deidentify.standardise_provider(df, "cust", KEYS, ["pk_mobno", "ref_nation"])[1]


@query("SELECT n_nationkey, n_name FROM nation")
def drop_index_column(t, spark):
    return link.drop_index_column(t("nation").select(F.lit(0).alias("_c0"), "n_nationkey", "n_name"))


@query("SELECT o.o_custkey AS key, o.o_totalprice AS amount, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey")
def drop_duplicate_columns(t, spark):
    o = t("orders").select(F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("amount"))
    k = t("customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"), "c_name")
    return link.drop_duplicate_columns(o.join(k, o["key"] == k["key"]))


@query("SELECT s_suppkey, s_nationkey FROM supplier")
def drop_columns(t, spark):
    return link.drop_columns(t("supplier").select("s_suppkey", "s_nationkey", "s_name"), ["s_name", "unknown"])


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def remove_identifiers(t, spark):
    return link.remove_identifiers(t("customer"), ["c_custkey", "c_name"]).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def select_variables(t, spark):
    return link.select_variables(t("orders"), ["o_orderstatus", "unknown"], ["o_orderkey"])[0]


@query("SELECT p_partkey, count(*) AS n FROM part GROUP BY 1")
def prune_available(t, spark):
    return link.prune_available(t("part"), ["p_partkey", "not_there"]).groupBy("p_partkey").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def split_features_target(t, spark):
    return encode.split_features_target(t("orders"), "o_orderstatus", ["o_orderkey", "o_totalprice"])


@query("""SELECT 'categorical' AS kind, 2 AS columns, count(o_orderstatus) + count(o_orderpriority) AS cells FROM orders
    UNION ALL SELECT 'numerical', 3, count(o_orderkey) + count(o_custkey) + count(o_totalprice) FROM orders UNION ALL SELECT 'excluded', 1, count(o_orderdate) FROM orders""")
def classify_columns(t, spark):
    o = t("orders")
    kinds = encode.classify_columns(o)
    filled = o.agg(*[sum((F.count(x) for x in names), F.lit(0)).alias(k) for k, names in kinds.items()])
    return filled.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(len(names)).alias("columns"), F.col(k).alias("cells")) for k, names in kinds.items()])))


# ---- missing values and filters

GAPS = "nullif(o_orderstatus, 'P') AS status, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS price"
EVENT_GAPS = "SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 7 < 3 THEN NULL ELSE value END AS value FROM events"


def gappy(t):
    return t("orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"))


def event_gaps(t):
    return t("events").select("event_id", "ts", F.when(F.col("event_id") % 3 != 0, F.col("user_id").cast("double")).alias("user_id"), F.when(F.col("event_id") % 7 >= 3, F.col("value")).alias("value"))


@query(f"SELECT * FROM (SELECT o_orderkey, {GAPS} FROM orders) WHERE status IS NOT NULL AND price IS NOT NULL")
def missing_drop(t, spark):
    return missing.missing_drop(gappy(t))


@query(f"SELECT o_orderkey, coalesce(status, '0') AS status, coalesce(price, 0.0) AS price FROM (SELECT o_orderkey, {GAPS} FROM orders)")
def missing_fill(t, spark):
    return missing.missing_fill(gappy(t), 0)


@query(f"""SELECT event_id, last_value(user_id IGNORE NULLS) OVER w ::DOUBLE AS user_id, last_value(value IGNORE NULLS) OVER w AS value
    FROM ({EVENT_GAPS}) WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def missing_ffill(t, spark):
    return missing.missing_ffill(event_gaps(t), [F.col("ts"), F.col("event_id")], ["user_id", "value"]).drop("ts")


@query(f"""SELECT event_id, first_value(user_id IGNORE NULLS) OVER w ::DOUBLE AS user_id, first_value(value IGNORE NULLS) OVER w AS value
    FROM ({EVENT_GAPS}) WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")
def missing_bfill(t, spark):
    return missing.missing_bfill(event_gaps(t), [F.col("ts"), F.col("event_id")], ["user_id", "value"]).drop("ts")


@query("SELECT l_linestatus, regexp_matches(l_linenumber::VARCHAR, '[2345]') AS past_due, count(*) AS n FROM lineitem GROUP BY 1, 2")
def status_past_due(t, spark):
    return t("lineitem").groupBy("l_linestatus", c.status_past_due(F.col("l_linenumber")).alias("past_due")).agg(F.count("*").alias("n"))


@query("SELECT vec_id FROM embeddings WHERE len(list_filter(embedding, lambda x: x > 0.3)) > 0")
def nonempty_target(t, spark):
    mask = c.binarize(F.col("embedding"), 0.3)
    return t("embeddings").filter(c.nonempty(mask)).select("vec_id")


# ---- links

LINK = "SELECT * FROM icmr a JOIN cowin b ON a.pk_mobno_hashed = b.pk_mobno_hashed JOIN idx d ON b.pk_mobno_hashed = d.pk_mobno_hashed"


def providers(t) -> dict[str, DataFrame]:
    """Three de-identified tables on one hashed key."""
    anon = lambda df, prefix, key: deidentify.standardise_provider(df, prefix, {key: "pk_mobno"}, ["pk_mobno"], {"pk_mobno": "long"})[1]
    return {
        "icmr": anon(t("customer").select("c_custkey", "c_mktsegment"), "icmr", "c_custkey"),
        "cowin": anon(t("orders").select("o_custkey", "o_orderpriority"), "cowin", "o_custkey"),
        "idx": anon(t("events").select("user_id", "event_type"), "index", "user_id"),
    }


@query("""SELECT DISTINCT c_mktsegment AS icmr_c_mktsegment, o_orderpriority AS cowin_o_orderpriority, event_type AS index_event_type, sha256(c_custkey::VARCHAR) AS pk_mobno_hashed
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN events ON c_custkey = user_id""")
def inner_link_3way(t, spark):
    return link.inner_link([p.distinct() for p in providers(t).values()], "pk_mobno_hashed")


@query("""SELECT c_mktsegment AS icmr_c_mktsegment, event_type AS index_event_type
    FROM (SELECT DISTINCT c_custkey, c_mktsegment, o_orderpriority, event_type FROM customer JOIN orders ON c_custkey = o_custkey
    JOIN events ON c_custkey = user_id)""")
def link_tables(t, spark):
    return link.link_tables(spark, providers(t), LINK, drop=["cowin_o_orderpriority"], identifiers=["pk_mobno_hashed"])


@query("""SELECT 'orders' AS source, count(o_custkey) AS n_keys, max(n) AS most, 0::BIGINT AS missing FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
   
    UNION ALL SELECT 'events', count(k), max(CASE WHEN k IS NOT NULL THEN n END), sum(CASE WHEN k IS NULL THEN n ELSE 0 END)::BIGINT
    FROM (SELECT nullif(user_id, 7) AS k, count(*) AS n FROM events GROUP BY 1)""")
def key_multiplicity(t, spark):
    keyed = {"orders": t("orders").select(F.col("o_custkey").alias("k")), "events": t("events").select(F.nullif("user_id", F.lit(7)).alias("k"))}
    return link.key_multiplicity({name: deidentify.pseudonymise(df, ["k"], {"k": "long"}) for name, df in keyed.items()}, "k_hashed")


@query("SELECT c_mktsegment, o_orderpriority, count(*) AS n FROM customer, orders WHERE c_custkey = o_custkey GROUP BY 1, 2")
def implicit_join(t, spark):
    joined = link.link_tables(spark, {"a": t("customer"), "b": t("orders")}, "SELECT * FROM a, b WHERE a.c_custkey = b.o_custkey", distinct_inputs=True)
    return joined.groupBy("c_mktsegment", "o_orderpriority").agg(F.count("*").alias("n"))


@query("""WITH x AS (SELECT c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey)
    SELECT 'missing' AS kind, 'target' AS "column", 0::BIGINT AS cells
    UNION ALL SELECT 'extra', 'c_name', count(c_name) FROM x UNION ALL SELECT 'extra', 'o_orderkey', count(o_orderkey) FROM x""")
def check_result_columns(t, spark):
    """Columns that a result lacks, and those that it should not have, with how many values they would give away."""
    linked = t("customer").select("c_custkey", "c_name").join(t("orders").select("o_custkey", "o_orderkey", "o_orderstatus"), F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")
    found = [(kind, name) for kind, names in link.check_result_columns(linked, ["c_custkey", "o_orderstatus", "target"]).items() for name in names]
    cells = linked.agg(*[(F.count(name) if name in linked.columns else F.lit(0).cast("long")).alias(name) for _, name in found])
    return cells.select(F.inline(F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("column"), F.col(name).alias("cells")) for kind, name in found])))


@query("""WITH RECURSIVE s(k) AS (SELECT 1 UNION ALL SELECT k + 1 FROM s WHERE k < 3)
    SELECT o_orderstatus AS status, k, count(*) AS n FROM orders JOIN s ON o_orderkey % 3 + 1 = k GROUP BY 1, 2 UNION ALL SELECT 'refused', 0, 6""")
def query_guard(t, spark):
    """A recursive query that may run, and how many others are refused: two statements, a change, another table by path, a call into the JVM (in the first column, or behind thirty), a product."""
    views = {"o": t("orders").select("o_orderkey", "o_orderstatus"), "c": t("customer").select("c_custkey")}
    path = _written(t("region"), spark, "parquet", tables.write_parquet)
    refused = 0
    for bad in ("SELECT 1; SELECT 2", "DROP TABLE o", f"SELECT * FROM parquet.`{path}`", "SELECT reflect('java.lang.System', 'getProperty', 'user.home') AS x FROM o",
        "SELECT * FROM o, c WHERE o_orderkey + c_custkey > 0", f"SELECT {', '.join(f'o_orderkey + {k} AS c{k}' for k in range(30))}, reflect('java.lang.System', 'getProperty', 'user.home') AS x FROM o"):
        try:
            link.link_tables(spark, views, bad)
        except ValueError:
            refused += 1
    good = """WITH RECURSIVE s(k) AS (SELECT 1 UNION ALL SELECT k + 1 FROM s WHERE k < 3) SELECT o_orderstatus AS status, k, count(*) AS n
    FROM o JOIN s ON o_orderkey % 3 + 1 = k GROUP BY 1, 2"""
    counted = link.link_tables(spark, views, good)
    return counted.unionByName(counted.select(F.lit("refused").alias("status"), F.lit(0).alias("k"), F.lit(refused).cast("long").alias("n")).limit(1))


@query("""SELECT c_mktsegment, c_nationkey, o.*, e.* EXCLUDE (user_id) FROM customer
    LEFT
    JOIN (SELECT o_custkey, count(o_totalprice) AS o_totalprice_count, round(avg(o_totalprice), 4) AS o_totalprice_mean, round(sum(o_totalprice), 2) AS o_totalprice_sum
    FROM orders GROUP BY 1) o ON c_custkey = o_custkey
    LEFT JOIN (SELECT user_id, round(max(value), 4) AS value_max, round(avg(value), 4) AS value_mean FROM events
    GROUP BY 1) e ON c_custkey = user_id""".replace("o.*,", "o.* EXCLUDE (o_custkey),"))
def left_star_join(t, spark):
    key = "SK_ID_CURR"
    base = t("customer").select(F.col("c_custkey").alias(key), "c_mktsegment", "c_nationkey")
    orders = aggregate.multi_agg(t("orders").withColumnRenamed("o_custkey", key), key, {"o_totalprice": ["count", "mean", "sum"]}).withColumn("o_totalprice_sum", r("o_totalprice_sum", 2))
    events = aggregate.multi_agg(t("events").withColumnRenamed("user_id", key), key, {"value": ["max", "mean"]})
    return rounded(link.remove_identifiers(link.left_star(base, [orders, events], key), [key]))


@query("SELECT o_custkey, o_orderkey, m::DOUBLE AS \"MONTHS_COUNT\", round(p, 4) AS \"STATUS_PAST_DUE_RATE\" FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS m, avg(CASE WHEN regexp_matches(l_linenumber::VARCHAR, '[2345]') THEN 1.0 ELSE 0.0 END) AS p FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey")
def left_attach_agg(t, spark):
    months = aggregate.bureau_month_agg(t("lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "l_linenumber")
    return rounded(aggregate.left_attach_agg(t("orders").select("o_orderkey", "o_custkey"), months, "o_orderkey").withColumn("MONTHS_COUNT", F.col("MONTHS_COUNT").cast("double")))


PROVIDERS = [f"src{k}" for k in (3, 1, 2, 0)]
MANIFEST = "SELECT doc_id, source AS provider, (doc_id % 100)::VARCHAR AS relative_path, array_position(['src3','src1','src2','src0'], source) AS p FROM documents"


@query(f"SELECT relative_path, doc_id, provider FROM (SELECT *, row_number() OVER (PARTITION BY relative_path ORDER BY p, doc_id) AS k FROM ({MANIFEST}) WHERE p > 0) WHERE k = 1")
def directory_union(t, spark):
    manifest = t("documents").select("doc_id", F.col("source").alias("provider"), (F.col("doc_id") % 100).cast("string").alias("relative_path"))
    single = manifest.groupBy("relative_path", "provider").agg(F.min("doc_id").alias("doc_id"))
    return link.directory_union(single, PROVIDERS).select("relative_path", "doc_id", "provider")


@query("SELECT relative_path, min(doc_id) AS doc_id FROM (SELECT doc_id, (doc_id % 50)::VARCHAR AS relative_path FROM documents) GROUP BY 1")
def first_wins(t, spark):
    return link.first_wins(t("documents").select("doc_id", (F.col("doc_id") % 50).cast("string").alias("relative_path")).withColumn("priority", F.col("doc_id")),
        "relative_path", "priority").select("relative_path", "doc_id")


@query("SELECT 'case_' || (doc_id // 4)::VARCHAR AS folder, 'case_' || (doc_id // 4)::VARCHAR AS id FROM documents WHERE doc_id % 4 IN (0, 1) GROUP BY 1 HAVING count(*) = 2")
def pair_files(t, spark):
    folder = F.concat(F.lit("case_"), F.floor(F.col("doc_id") / 4).cast("string"))
    suffix = F.element_at(F.array(*[F.lit(x) for x in ("_flair.png", "_seg.png", "_t1.png", "_t2.png")]), (F.col("doc_id") % 4 + 1).cast("int"))
    manifest = t("documents").select(F.concat(F.lit("/data/"), folder, F.lit("/"), folder, suffix).alias("path"))
    return link.pair_files(manifest, "case_*", "{id}_flair.png", "{id}_seg.png").select("folder", "id")


# ---- aggregates


def installments(t):
    lines = t("lineitem").join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(F.col("o_custkey").alias("SK_ID_CURR"), F.col("l_extendedprice").alias("AMT_PAYMENT"), (F.col("l_quantity") * 1000).alias("AMT_INSTALMENT"),
        F.nullif("l_linenumber", F.lit(7)).alias("n")).withColumn("DAYS_ENTRY_PAYMENT", F.col("n") - 4)


INSTALLMENTS = "SELECT o_custkey AS k, l_extendedprice AS paid, l_quantity * 1000 AS due, nullif(l_linenumber, 7) - 4 AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


@query("""SELECT o_custkey, count(o_totalprice) AS o_totalprice_count, round(avg(o_totalprice), 4) AS o_totalprice_mean, round(coalesce(sum(o_totalprice), 0), 2) AS o_totalprice_sum,
    round(max(o_totalprice), 4) AS o_totalprice_max, round(min(o_totalprice), 4) AS o_totalprice_min FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1""")
def multi_agg(t, spark):
    return rounded(aggregate.multi_agg(t("orders"), "o_custkey", {"o_totalprice": ["count", "mean", "sum", "max", "min"]}).withColumn("o_totalprice_sum", r("o_totalprice_sum", 2)))


@query("""SELECT o_custkey AS "SK_ID_CURR", count(o_totalprice) AS "AMT_APPLICATION_count", round(avg(o_totalprice), 4) AS "AMT_APPLICATION_mean", round(sum(o_totalprice), 2) AS "AMT_APPLICATION_sum",
    round(avg(o_totalprice * 0.9), 4) AS "AMT_CREDIT_mean", round(max(o_totalprice * 0.9), 4) AS "AMT_CREDIT_max", round(avg(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice * 0.1 END), 4) AS "AMT_DOWN_PAYMENT_mean",
    round(avg(o_orderkey % 24), 4) AS "CNT_PAYMENT_mean" FROM orders GROUP BY 1""")
def prev_app_agg(t, spark):
    p = F.col("o_totalprice")
    df = t("orders").select(F.col("o_custkey").alias("SK_ID_CURR"), p.alias("AMT_APPLICATION"), (p * 0.9).alias("AMT_CREDIT"), F.when(F.col("o_orderkey") % 5 != 0,
        p * 0.1).alias("AMT_DOWN_PAYMENT"), (F.col("o_orderkey") % 24).alias("CNT_PAYMENT"))
    return rounded(aggregate.prev_app_agg(df).withColumn("AMT_APPLICATION_sum", r("AMT_APPLICATION_sum", 2)))


@query(f"""SELECT k AS "SK_ID_CURR", round(sum(paid), 2) AS "AMT_PAYMENT_sum", round(avg(paid), 4) AS "AMT_PAYMENT_mean", round(sum(due), 2) AS "AMT_INSTALMENT_sum",
    round(avg(due), 4) AS "AMT_INSTALMENT_mean",
    round(avg(paid - due), 4) AS "PAYMENT_DIFF_mean", sum(CASE WHEN days > 0 THEN 1 ELSE 0 END)::BIGINT AS "LATE_PAYMENT_sum", round(avg(CASE WHEN days > 0 THEN 1.0 ELSE 0.0 END), 4) AS "LATE_PAYMENT_mean"
    FROM ({INSTALLMENTS}) GROUP BY 1""")
def installment_agg(t, spark):
    return rounded(aggregate.installment_agg(installments(t)).withColumns({k: r(k, 2) for k in ("AMT_PAYMENT_sum", "AMT_INSTALMENT_sum")}))


@query("""SELECT o_custkey AS "SK_ID_CURR", round(avg(l_extendedprice), 4) AS "AMT_BALANCE_mean", round(max(l_extendedprice), 4) AS "AMT_BALANCE_max",
    max(l_linenumber)::INTEGER AS "SK_DPD_max", round(avg(l_linenumber), 4) AS "SK_DPD_mean"
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def card_balance_agg(t, spark):
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rounded(aggregate.card_balance_agg(lines.select(F.col("o_custkey").alias("SK_ID_CURR"), F.col("l_extendedprice").alias("AMT_BALANCE"), F.col("l_linenumber").alias("SK_DPD"))))


BUREAU_MONTH = "SELECT l_orderkey, count(*) AS m, avg(CASE WHEN regexp_matches(l_linenumber::VARCHAR, '[2345]') THEN 1.0 ELSE 0.0 END) AS p FROM lineitem GROUP BY 1"


@query(f'SELECT l_orderkey AS "SK_ID_BUREAU", m AS "MONTHS_COUNT", round(p, 4) AS "STATUS_PAST_DUE_RATE" FROM ({BUREAU_MONTH})')
def bureau_month_agg(t, spark):
    return rounded(aggregate.bureau_month_agg(t("lineitem").select(F.col("l_orderkey").alias("SK_ID_BUREAU"), F.col("l_linenumber").alias("STATUS"))))


@query(f"""SELECT o_custkey AS "SK_ID_CURR", round(avg(o_totalprice), 4) AS "AMT_CREDIT_SUM_mean", round(max(o_totalprice), 4) AS "AMT_CREDIT_SUM_max",
    count(*)::BIGINT AS "BUREAU_COUNT_sum", round(avg(p), 4) AS "STATUS_PAST_DUE_RATE_mean"
    FROM orders LEFT JOIN ({BUREAU_MONTH}) ON o_orderkey = l_orderkey GROUP BY 1""")
def bureau_agg(t, spark):
    bureau = t("orders").select(F.col("o_orderkey").alias("SK_ID_BUREAU"), F.col("o_custkey").alias("SK_ID_CURR"), F.col("o_totalprice").alias("AMT_CREDIT_SUM"))
    balance = t("lineitem").select(F.col("l_orderkey").alias("SK_ID_BUREAU"), F.col("l_linenumber").alias("STATUS"))
    return rounded(aggregate.bureau_agg(bureau, balance, past_due=True))


@query("""SELECT user_id AS "SK_ID_CURR", round(max(value), 4) AS "SK_DPD_max", round(avg(value), 4) AS "SK_DPD_mean",
    count(event_id) AS "MONTHS_BALANCE_count" FROM events WHERE user_id IS NOT NULL GROUP BY 1""")
def pos_cash_agg(t, spark):
    return rounded(aggregate.pos_cash_agg(t("events").select(F.col("user_id").alias("SK_ID_CURR"), F.col("value").alias("SK_DPD"), F.col("event_id").alias("MONTHS_BALANCE"))))


@query("SELECT s_nationkey, round(avg(s_suppkey), 4) AS s_suppkey_mean, max(s_suppkey) AS s_suppkey_max FROM supplier GROUP BY 1")
def fallback_numeric_agg(t, spark):
    return rounded(aggregate.fallback_numeric_agg(t("supplier").select("s_nationkey", "s_suppkey", "s_name"), "s_nationkey"))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(t, spark):
    return link.distinct_rows(t("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def class_counts(t, spark):
    return aggregate.class_counts(t("orders"), "o_orderstatus")


@query("SELECT round(sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) / sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END), 6) AS scale_pos_weight FROM labels")
def scale_pos_weight(t, spark):
    return rounded(aggregate.scale_pos_weight(t("labels"), "quality"), 6)


@query("""SELECT 'o_totalprice' AS feature, min(o_totalprice) AS least, max(o_totalprice) AS most FROM orders
    UNION ALL SELECT 'o_custkey', min(o_custkey)::DOUBLE, max(o_custkey)::DOUBLE FROM orders""")
def feature_bounds(t, spark):
    return aggregate.feature_bounds(t("orders"), ["o_totalprice", "o_custkey"])


@query('SELECT \'o_orderpriority\' AS "column", count(DISTINCT o_orderpriority) AS n FROM orders UNION ALL SELECT \'status\', count(DISTINCT nullif(o_orderstatus, \'P\')) + max((o_orderstatus = \'P\')::INTEGER) FROM orders')
def category_cardinality(t, spark):
    return aggregate.category_cardinality(t("orders").select("o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("status")), ["o_orderpriority", "status"])


# ---- scalar functions


@query("SELECT c_custkey, round(c_acctbal / (CASE WHEN c_nationkey % 3 = 0 THEN 1 ELSE c_nationkey % 3 END + 1), 4) AS income_per_person FROM customer")
def income_per_person(t, spark):
    return t("customer").select("c_custkey", r(c.income_per_person(F.col("c_acctbal"), F.col("c_nationkey") % 3)).alias("income_per_person"))


@query("SELECT o_orderkey, round(o_totalprice / (CASE WHEN o_custkey % 10 = 0 THEN 1 ELSE o_custkey % 10 END), 4) AS credit_to_income FROM orders")
def credit_to_income(t, spark):
    return t("orders").select("o_orderkey", r(c.credit_to_income(F.col("o_totalprice"), F.col("o_custkey") % 10)).alias("credit_to_income"))


@query(f"SELECT k, round(sum(paid - due), 2) AS payment_diff FROM ({INSTALLMENTS}) GROUP BY 1")
def payment_diff(t, spark):
    return installments(t).groupBy(F.col("SK_ID_CURR").alias("k")).agg(r(F.sum(c.payment_diff(F.col("AMT_PAYMENT"), F.col("AMT_INSTALMENT"))), 2).alias("payment_diff"))


@query(f"SELECT CASE WHEN days > 0 THEN 1 ELSE 0 END AS late, count(*) AS n FROM ({INSTALLMENTS}) GROUP BY 1")
def late_flag(t, spark):
    return installments(t).groupBy(c.late_flag(F.col("DAYS_ENTRY_PAYMENT")).alias("late")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey AS "SK_ID_CURR", (c_acctbal < 0)::INTEGER AS "TARGET", round(c_acctbal / (CASE WHEN c_nationkey % 3 = 0 THEN 1 ELSE c_nationkey % 3 END + 1), 4) AS "INCOME_PER_PERSON",
    round(5000.0 / CASE WHEN c_acctbal = 0 THEN 1 ELSE c_acctbal END, 4) AS "CREDIT_TO_INCOME", c_mktsegment FROM customer WHERE c_nationkey <> 7""")
def app_learn(t, spark):
    base = t("customer").select(
        F.col("c_custkey").alias("SK_ID_CURR"), (F.col("c_acctbal") < 0).cast("int").alias("TARGET"), F.col("c_acctbal").alias("AMT_INCOME_TOTAL"),
        (F.nullif("c_nationkey", F.lit(7)) % 3).alias("CNT_CHILDREN"), F.lit(5000.0).alias("AMT_CREDIT"), "c_mktsegment",
    )
    return rounded(aggregate.app_learn(base))


@query("SELECT c_custkey, replace(c_name, 'Customer#', '') AS identifier FROM customer")
def strip_affixes(t, spark):
    return t("customer").select("c_custkey", c.strip_affixes(F.col("c_name"), "Customer#").alias("identifier"))


@query("""SELECT doc_id, source || '/' || doc_id::VARCHAR || '.txt' AS relative, doc_id::VARCHAR || '.txt' AS base, source || '_' || doc_id::VARCHAR || '_x' AS filled
    FROM documents""")
def path_parts(t, spark):
    path = F.concat(F.lit("/data/root/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return t("documents").select("doc_id", c.relative_path(path, "/data/root").alias("relative"), c.base_name(path).alias("base"), c.filled_pattern("*_{id}_x",
        F.col("source"), F.col("doc_id").cast("string")).alias("filled"))


@query("SELECT vec_id, i::INTEGER AS i, round(embedding[32 + i]::DOUBLE, 5) AS v FROM embeddings, (SELECT unnest(range(1, 9)) AS i)")
def middle_slice(t, spark):
    planes = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.slice("embedding", k * 8 + 1, 8))
    return t("embeddings").select("vec_id", F.posexplode(c.middle_slice(planes, F.lit(8))).alias("i", "v")).select("vec_id", (F.col("i") + 1).alias("i"), r(F.col("v").cast("double"), 5).alias("v"))


WIDE = "SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE * 100)) AS e FROM embeddings"


def wide(t):
    return t("embeddings").select("vec_id", F.transform("embedding", lambda x: F.round(x.cast("double") * 100)).alias("e"))


#: Every third row is pushed below zero, where pixels stay as they are.
SUNK = f"SELECT vec_id, list_transform(e, lambda x: CASE WHEN vec_id % 3 = 0 THEN x - 1000 ELSE x END) AS e FROM ({WIDE})"


@query(f"""SELECT vec_id,
    CASE WHEN list_max(e) > 0 AND list_max(e) > list_min(e) THEN list_sum(list_transform(e, lambda x: trunc((x - list_min(e)) / (list_max(e) - list_min(e)) * 255)::BIGINT))
    ELSE list_sum(list_transform(e, lambda x: trunc(x)::BIGINT)) END::BIGINT AS total FROM ({SUNK})""")
def minmax_uint8(t, spark):
    sunk = wide(t).withColumn("e", F.transform("e", lambda x: F.when(F.col("vec_id") % 3 == 0, x - 1000).otherwise(x)))
    return sunk.select("vec_id", F.aggregate(c.minmax_uint8(F.col("e")), F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query(f"SELECT vec_id, round(list_sum(list_transform(e, lambda x: x / 255.0)), 4) AS total FROM ({WIDE})")
def to_unit_interval(t, spark):
    return wide(t).select("vec_id", r(F.aggregate(c.to_unit_interval(F.col("e")), F.lit(0.0), lambda a, x: a + x)).alias("total"))


@query(f"""SELECT vec_id, (i - 1)::INTEGER AS i, round(0.299 * e[42 + i] + 0.587 * e[21 + i] + 0.114 * e[i], 4) AS luma FROM ({WIDE}), (SELECT unnest(range(1, 22)) AS i)""")
def grayscale(t, spark):
    """The first 63 values as three planes of 21 pixels: blue, green, red."""
    pixels = F.arrays_zip(*[F.slice("e", 21 * k + 1, 21).alias(name) for k, name in enumerate(("blue", "green", "red"))])
    each = wide(t).select("vec_id", F.posexplode(pixels).alias("i", "p"))
    return each.select("vec_id", "i", r(c.grayscale(F.col("p.blue"), F.col("p.green"), F.col("p.red"))).alias("luma"))


@query("SELECT vec_id, len(list_filter(embedding, lambda x: x > 0))::DOUBLE AS ones FROM embeddings")
def binarize(t, spark):
    return t("embeddings").select("vec_id", F.aggregate(c.binarize(F.col("embedding")), F.lit(0.0), lambda a, x: a + x).alias("ones"))


@query(f"SELECT vec_id, round(list_sum(list_transform(e, lambda x: (x - 0.1307) / 0.3081)), 3) AS total FROM ({WIDE})")
def channel_normalise(t, spark):
    return wide(t).select("vec_id", r(F.aggregate(c.channel_normalise(F.col("e")), F.lit(0.0), lambda a, x: a + x), 3).alias("total"))


@query("SELECT doc_id, dense_rank() OVER (ORDER BY source) - 1 AS class_index FROM documents")
def class_index(t, spark):
    return files.class_index(t("documents").select("doc_id", "source"), "source").select("doc_id", "class_index")


# ---- encoding, scaling, splits


@query("SELECT greatest(2, floor(0.01 * count(*)))::BIGINT AS threshold FROM orders")
def encoding_threshold(t, spark):
    o = t("orders")
    return o.agg(F.lit(encode.encoding_threshold(o.count())).cast("long").alias("threshold"))


@query("""SELECT o_orderkey, coalesce((s = 'F')::INTEGER, 0) AS "s_F", coalesce((s = 'O')::INTEGER, 0) AS "s_O", (s IS NULL)::INTEGER AS s_nan FROM (SELECT o_orderkey,
    nullif(o_orderstatus, 'P') AS s FROM orders)""")
def one_hot(t, spark):
    return encode.one_hot(t("orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("s")), "s")


@query("SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::DOUBLE AS o_orderpriority_ord FROM orders")
def ordinal(t, spark):
    return encode.ordinal(t("orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority")


@query("""SELECT o_orderkey, coalesce(code, -1) AS o_orderpriority_ord FROM orders LEFT
    JOIN (SELECT v, (row_number() OVER (ORDER BY v) - 1)::DOUBLE AS code FROM (SELECT DISTINCT o_orderpriority AS v FROM orders
    WHERE o_orderpriority < '3')) ON o_orderpriority = v""")
def ordinal_unknown(t, spark):
    o = t("orders").select("o_orderkey", "o_orderpriority")
    return encode.ordinal(o, "o_orderpriority", encode.dictionary(o.filter("o_orderpriority < '3'"), "o_orderpriority"))


@query("""SELECT o_orderkey, o_totalprice, (o_orderstatus = 'F')::INTEGER AS "o_orderstatus_F", (o_orderstatus = 'O')::INTEGER AS "o_orderstatus_O",
    (o_orderstatus = 'P')::INTEGER AS "o_orderstatus_P", 0 AS o_orderstatus_nan,
    (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::DOUBLE AS o_orderpriority_ord FROM orders""")
def build_matrix(t, spark):
    return encode.build_matrix(t("orders"), {"o_orderstatus": "one_hot", "o_orderpriority": "ordinal"}, ["o_totalprice"], ["o_orderkey"])[0]


@query('''SELECT "column", n, CASE WHEN n > greatest(2, floor(0.01 * (SELECT count(*) FROM customer))) THEN 'ordinal' WHEN n > 3 THEN 'one_hot_sparse' ELSE 'one_hot' END AS kind
    FROM (SELECT 'c_mktsegment' AS "column", count(DISTINCT c_mktsegment) AS n FROM customer UNION ALL SELECT 'c_name', count(DISTINCT c_name) FROM customer
    UNION ALL SELECT 'sign', count(DISTINCT c_acctbal < 0) FROM customer)''')
def encoding_plan(t, spark):
    df = t("customer").withColumn("sign", (F.col("c_acctbal") < 0).cast("string"))
    return encode.encoding_plan(df, ["c_mktsegment", "c_name", "sign"], max_wide=3)


CODES = "SELECT v, (row_number() OVER (ORDER BY v) - 1)::DOUBLE AS code FROM (SELECT DISTINCT {0} AS v FROM orders WHERE {1})"


@query(f"""SELECT 'o_orderpriority' AS "column", 'ordinal' AS kind, v AS category, code FROM ({CODES.format("o_orderpriority", "true")})
    UNION ALL SELECT 'status', 'one_hot', v, code FROM ({CODES.format("o_orderstatus", "o_orderstatus <> 'P'")})""")
def fitted_encoding(t, spark):
    df = t("orders").select("o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return encode.fitted_encoding(df, {"o_orderpriority": "ordinal", "status": "one_hot"})


@query(f"""SELECT o_orderkey, coalesce((o_orderstatus = 'F')::INTEGER, 0) AS "o_orderstatus_F",
    (o_orderstatus = 'O')::INTEGER AS "o_orderstatus_O", 0 AS o_orderstatus_nan, coalesce(code, -1)::BIGINT AS o_orderpriority_hot
    FROM orders LEFT JOIN ({CODES.format("o_orderpriority", "o_orderpriority < '3' AND o_orderstatus <> 'P'")}) ON o_orderpriority = v""")
def build_matrix_fitted(t, spark):
    """A matrix of all rows with the encoding fitted on some: unseen values get no one, and no column is added."""
    kinds = {"o_orderstatus": "one_hot", "o_orderpriority": "one_hot_sparse"}
    o = t("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    fitted = encode.fitted_encoding(o.filter("o_orderpriority < '3' AND o_orderstatus <> 'P'"), kinds)
    return encode.build_matrix(o, kinds, [], ["o_orderkey"], fitted)[0]


TRAIN = "o_orderkey % 3 <> 0"


@query(f"SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS o_totalprice FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders WHERE {TRAIN})")
def scale_standard(t, spark):
    return rounded(scale.scale(t("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"], "standard", F.expr(TRAIN)), 6)


@query(f"SELECT o_orderkey, round((o_totalprice - a) / (b - a), 6) AS o_totalprice FROM orders, (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders WHERE {TRAIN})")
def scale_minmax(t, spark):
    return rounded(scale.scale(t("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"], "minmax", F.expr(TRAIN)), 6)


@query(f"""SELECT o_orderkey, round((o_totalprice - q[2]) / (q[3] - q[1]), 6) AS o_totalprice
    FROM orders, (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS q FROM orders WHERE {TRAIN})""")
def scale_robust(t, spark):
    return rounded(scale.scale(t("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"], "robust", F.expr(TRAIN)), 6)


@query("""SELECT l_orderkey, round(sum(l_quantity / sqrt(l_quantity ** 2 + l_tax ** 2)), 4) AS q, round(sum(l_tax / sqrt(l_quantity ** 2 + l_tax ** 2)), 4) AS x
    FROM lineitem GROUP BY 1""")
def scale_rowl2(t, spark):
    df = scale.scale_rowl2(t("lineitem").select("l_orderkey", "l_quantity", "l_tax"), ["l_quantity", "l_tax"])
    return df.groupBy("l_orderkey").agg(r(F.sum("l_quantity")).alias("q"), r(F.sum("l_tax")).alias("x"))


RATIOS = (0.7, 0.2, 0.1)
_TOTAL = RATIOS[0] + RATIOS[1] + RATIOS[2]  # plain additions; sum() rounds otherwise
_R = tuple(x / _TOTAL for x in RATIOS)
RANKED = "SELECT *, row_number() OVER (ORDER BY sha256('42:' || o_orderkey::VARCHAR)) AS k, count(*) OVER () AS n FROM orders"
SIZED = f"SELECT *, ceil('{_R[2]!r}'::DOUBLE * n) AS test, ceil('{_R[1] / (_R[1] + _R[0])!r}'::DOUBLE * (n - ceil('{_R[2]!r}'::DOUBLE * n))) AS val FROM"


@query(f"SELECT o_orderkey, CASE WHEN k <= test THEN 'test' WHEN k <= test + val THEN 'val' ELSE 'train' END AS split FROM ({SIZED} ({RANKED}))")
def split_exact(t, spark):
    return split.split_exact(t("orders").select("o_orderkey"), ["o_orderkey"], RATIOS)


@query(f"""SELECT split, count(*) AS n_rows, 1 AS n_features FROM (SELECT
    CASE WHEN k <= test THEN 'test' WHEN k <= test + val THEN 'val' ELSE 'train' END AS split FROM ({SIZED} ({RANKED})))
    GROUP BY 1""")
def split_summary(t, spark):
    return split.split_summary(split.split_unsupervised(t("orders").select("o_orderkey"), ["o_orderkey"], RATIOS))


@query(f"""SELECT doc_id, CASE WHEN k <= test THEN 'test' WHEN k <= test + val THEN 'val' ELSE 'train' END AS split
    FROM ({SIZED} (SELECT doc_id, row_number() OVER (ORDER BY sha256('42:' || doc_id::VARCHAR)) AS k, count(*) OVER () AS n
    FROM documents))""")
def split_unsupervised(t, spark):
    return split.split_unsupervised(t("documents").select("doc_id"), ["doc_id"], RATIOS)


@query(f"""WITH c AS (SELECT o_orderstatus AS s, count(*) AS k, sum(count(*)) OVER () AS n FROM orders GROUP BY 1),
    z AS (SELECT ceil('{_R[2]!r}'::DOUBLE * n)::BIGINT AS test, ceil('{_R[1] / (_R[1] + _R[0])!r}'::DOUBLE * (n - ceil('{_R[2]!r}'::DOUBLE * n)))::BIGINT AS val
    FROM (SELECT count(*) AS n FROM orders)),
    a AS (SELECT s, k, n, (k * test) // n AS q, row_number() OVER (ORDER BY (k * test) % n DESC, s) AS p, test - sum((k * test) // n) OVER () AS e FROM c, z),
    b AS (SELECT s, k, q + (p <= e)::INTEGER AS test FROM a),
    d AS (SELECT s, test, k - test AS k, sum(k - test) OVER () AS n FROM b),
    f AS (SELECT s, d.test AS test, (k * val) // n AS q, row_number() OVER (ORDER BY (k * val) % n DESC, s) AS p, val - sum((k * val) // n) OVER () AS e FROM d, z),
    g AS (SELECT s, test, q + (p <= e)::INTEGER AS val FROM f)
    SELECT o_orderkey, o_orderstatus, CASE WHEN k <= test THEN 'test' WHEN k <= test + val THEN 'val' ELSE 'train' END AS split
    FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY sha256('42:' || o_orderkey::VARCHAR)) AS k FROM orders) JOIN g ON o_orderstatus = s""")
def split_stratified(t, spark):
    return split.split_stratified(t("orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], "o_orderstatus", RATIOS)


@query("SELECT o_orderkey, 'train' AS split FROM orders")
def split_none(t, spark):
    return split.split_none(t("orders").select("o_orderkey"))


@query(f"""SELECT o_orderkey,
    CASE WHEN h < '{_R[2]!r}'::DOUBLE THEN 'test' WHEN h < '{(RATIOS[1] + RATIOS[2]) / _TOTAL!r}'::DOUBLE THEN 'val' ELSE 'train' END AS split
    FROM (SELECT o_orderkey, ('0x' || sha256('42:' || o_orderkey::VARCHAR)[1:8])::BIGINT / 4294967296.0 AS h FROM orders)""")
def random_sample_split(t, spark):
    return split.random_sample_split(t("orders").select("o_orderkey"), ["o_orderkey"], RATIOS)


# ---- metrics

BINARY = """SELECT doc_id AS id, quality AS label, (n_chars % 1000) / 1000.0::DOUBLE AS score, ((n_chars % 1000) / 1000.0::DOUBLE > 0.5)::INTEGER AS pred
    FROM labels JOIN documents USING (doc_id)"""
MULTI = "SELECT vec_id AS id, label, embedding[1:10] AS scores, list_position(embedding[1:10], list_max(embedding[1:10])) - 1 AS pred FROM embeddings"


def binary(t):
    df = t("labels").join(t("documents").select("doc_id", "n_chars"), "doc_id")
    return df.select(F.col("doc_id").alias("id"), F.col("quality").alias("label"), ((F.col("n_chars") % 1000) / 1000.0).alias("score")).withColumn("pred", metrics.predict_label(F.col("score")))


def multi(t):
    return t("embeddings").select(F.col("vec_id").alias("id"), "label", F.slice("embedding", 1, 10).alias("scores")).withColumn("pred", metrics.predict_class(F.col("scores")))


def prices(t):
    return t("lineitem").select(F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1000.0 + 500).alias("score"))


@query(f"SELECT id, pred::INTEGER AS pred FROM ({MULTI})")
def predict_label(t, spark):
    return multi(t).select("id", "pred")


@query(f"SELECT round(avg((label = pred)::INTEGER), 6) AS accuracy FROM ({BINARY})")
def accuracy(t, spark):
    return rounded(metrics.accuracy(binary(t)), 6)


@query(f"""WITH x AS ({MULTI}), cs AS (SELECT label AS c FROM x UNION SELECT pred FROM x)
    SELECT a.c AS label, b.c AS pred, count(x.id) AS n FROM cs a CROSS JOIN cs b LEFT JOIN x ON x.label = a.c AND x.pred = b.c GROUP BY 1, 2""")
def confusion_matrix(t, spark):
    return metrics.confusion_matrix(multi(t)).select(F.col("label").cast("long").alias("label"), F.col("pred").cast("long").alias("pred"), "n")


PER_CLASS = """SELECT c, sum((label = c)::INTEGER) AS s, sum((pred = c)::INTEGER) AS m, sum((label = c AND pred = c)::INTEGER) AS h
    FROM x, (SELECT label AS c FROM x UNION SELECT pred FROM x) GROUP BY 1"""
SCORED = f"SELECT c, s, h, CASE WHEN m = 0 THEN 0.0 ELSE h / m END AS p, CASE WHEN s = 0 THEN 0.0 ELSE h / s END AS r FROM ({PER_CLASS})"
F1 = f"SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM ({SCORED})"


@query(f"WITH x AS ({BINARY}) SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM ({F1}) WHERE c = 1", name="precision_recall_f1_binary")
def prf_binary(t, spark):
    return rounded(metrics.averaged(binary(t)), 6)


for _average, _weight in (("macro", "1"), ("weighted", "s")):
    query(f"""WITH x AS ({MULTI}) SELECT round(sum(p * {_weight}) / sum({_weight}), 6) AS precision, round(sum(r * {_weight}) / sum({_weight}), 6) AS recall,
        round(sum(f * {_weight}) / sum({_weight}), 6) AS f1
    FROM ({F1})""", name=f"precision_recall_f1_{_average}")(
        lambda t, spark, a=_average: rounded(metrics.averaged(multi(t), a), 6)
    )


@query(f"""SELECT round(avg((label = pred)::INTEGER), 6) AS precision, round(avg((label = pred)::INTEGER), 6) AS recall, round(avg((label = pred)::INTEGER), 6) AS f1
    FROM ({MULTI})""", name="precision_recall_f1_micro")
def prf_micro(t, spark):
    return rounded(metrics.averaged(multi(t), "micro"), 6)


@query(f"""WITH x AS ({MULTI}), y AS ({F1}), a AS (SELECT sum(h) / sum(s) AS v, sum(s) AS n FROM y)
    SELECT c::VARCHAR AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, s::BIGINT AS support FROM y
    UNION ALL SELECT 'accuracy', round(v, 6), round(v, 6), round(v, 6), n::BIGINT FROM a
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(s)::BIGINT FROM y
    UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6), round(sum(f * s) / sum(s), 6), sum(s)::BIGINT FROM y""")
def classification_report(t, spark):
    return rounded(metrics.classification_report(multi(t)), 6)


BY_SCORE = "SELECT score, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM x GROUP BY 1"
SUMS = f"SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM ({BY_SCORE})"


@query(f"WITH x AS ({BINARY}) SELECT round(sum(neg * (tp - pos + pos / 2.0)) / (max(p) * max(n)), 6) AS roc_auc FROM ({SUMS})")
def roc_auc(t, spark):
    return rounded(metrics.roc_auc(binary(t)), 6)


@query(f"WITH x AS ({BINARY}) SELECT round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr, round(score, 6) AS threshold FROM ({SUMS}) UNION ALL SELECT 0.0, 0.0, 'inf'::DOUBLE")
def roc_curve(t, spark):
    return rounded(metrics.roc_curve(binary(t)), 6)


@query(f"WITH x AS ({BINARY}) SELECT round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall, round(score, 6) AS threshold FROM ({SUMS}) UNION ALL SELECT 1.0, 0.0, NULL")
def precision_recall_curve(t, spark):
    return rounded(metrics.precision_recall_curve(binary(t)), 6)


@query(f"""WITH m AS ({MULTI}), e AS (SELECT label, unnest(range(0, 10)) AS class, unnest(scores)::DOUBLE AS score FROM m),
    g AS (SELECT class, score, sum((label = class)::INTEGER) AS pos, sum((label <> class)::INTEGER) AS neg FROM e GROUP BY 1, 2),
    w AS (SELECT *, sum(pos) OVER (PARTITION BY class ORDER BY score DESC) AS tp, sum(pos) OVER (PARTITION BY class) AS p, sum(neg) OVER (PARTITION BY class) AS n FROM g),
    a AS (SELECT class, sum(neg * (tp - pos + pos / 2.0)) / (max(p) * max(n)) AS v FROM w WHERE p > 0 AND n > 0 GROUP BY 1)
    SELECT round(avg(v), 6) AS roc_auc FROM a""")
def roc_auc_multiclass(t, spark):
    return rounded(metrics.roc_auc_multiclass(multi(t)), 6)


@query(f"""WITH m AS ({MULTI}), cs AS (SELECT DISTINCT label AS c FROM m),
    e AS (SELECT label, unnest(range(0, 10)) AS class, unnest(scores)::DOUBLE AS score FROM m),
    p AS (SELECT a.c AS a, b.c AS b, e.score, (e.label = a.c)::INTEGER AS y FROM cs a, cs b, e WHERE a.c <> b.c AND e.class = a.c AND e.label IN (a.c, b.c)),
    g AS (SELECT a, b, score, sum(y) AS pos, sum(1 - y) AS neg FROM p GROUP BY 1, 2, 3),
    w AS (SELECT *, sum(pos) OVER (PARTITION BY a, b ORDER BY score DESC) AS tp, sum(pos) OVER (PARTITION BY a, b) AS p, sum(neg) OVER (PARTITION BY a, b) AS n FROM g),
    v AS (SELECT a, b, sum(neg * (tp - pos + pos / 2.0)) / (max(p) * max(n)) AS v FROM w WHERE p > 0 AND n > 0 GROUP BY 1, 2)
    SELECT round(avg(v), 6) AS roc_auc FROM v""")
def roc_auc_ovo(t, spark):
    return rounded(metrics.roc_auc_multiclass(multi(t), "ovo"), 6)


@query("""WITH x AS (SELECT l_extendedprice AS y, l_quantity * 1000.0 + 500 AS s FROM lineitem)
    SELECT round(avg((y - s) ** 2), 2) AS mse, round(avg(abs(y - s)), 4) AS mae, round(sqrt(avg((y - s) ** 2)), 4) AS rmse, round(1 - avg((y - s) ** 2) / var_pop(y), 6) AS r2_score
    FROM x""", name="mse_mae_rmse_r2")
def regression(t, spark):
    return metrics.regression(prices(t)).select(r("mse", 2).alias("mse"), r("mae").alias("mae"), r("rmse").alias("rmse"), r("r2_score", 6).alias("r2_score"))


MASKS = "SELECT a.vec_id AS image_id, a.embedding AS pred, b.embedding AS truth FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0"


def masks(t):
    e = t("embeddings")
    truth = e.select((F.col("vec_id") - 1).alias("image_id"), F.col("embedding").alias("truth"))
    return e.filter("vec_id % 2 = 0").select(F.col("vec_id").alias("image_id"), F.col("embedding").alias("pred")).join(truth, "image_id").withColumn("width", F.lit(8))


@query(f"""WITH m AS ({MASKS}), x AS (SELECT unnest(pred) > 0.1 AS p, unnest(truth) > 0.1 AS t
    FROM m), s AS (SELECT sum(p::INTEGER) AS p, sum(t::INTEGER) AS t, sum((p AND t)::INTEGER) AS b FROM x)
    SELECT round(2.0 * b / (p + t + 1e-6), 6) AS dice_score, round(b / (p + t - b), 6) AS jaccard_index FROM s""", name="dice_score_jaccard_index")
def dice(t, spark):
    return rounded(metrics.segmentation(masks(t), 0.1), 6)


@query(f"""WITH m AS ({MASKS}), x AS (SELECT image_id, unnest(range(0, 64)) AS i, unnest(pred) > 0.1 AS p, unnest(truth) > 0.1 AS t FROM m),
    d AS (SELECT a.image_id, a.i AS ai, b.i AS bi, sqrt((a.i // 8 - b.i // 8) ** 2 + (a.i % 8 - b.i % 8) ** 2) AS d FROM x a JOIN x b ON a.image_id = b.image_id AND a.p AND b.t),
    f AS (SELECT image_id, max(v) AS v FROM (SELECT image_id, min(d) AS v FROM d GROUP BY image_id, ai UNION ALL SELECT image_id, min(d) FROM d GROUP BY image_id, bi) GROUP BY 1)
    SELECT image_id, round(coalesce(v, 'inf'::DOUBLE), 6) AS distance FROM (SELECT image_id FROM m) LEFT JOIN f USING (image_id)""")
def hausdorff_distance(t, spark):
    return rounded(metrics.hausdorff_each(masks(t), 0.1), 6)


@query(f"""WITH x AS ({BINARY}) SELECT 'accuracy' AS metric, round(avg((label = pred)::INTEGER), 6) AS value FROM x
    UNION ALL SELECT 'recall', round(r, 6) FROM ({F1}) WHERE c = 1 UNION ALL SELECT 'precision', round(p, 6) FROM ({F1}) WHERE c = 1
    UNION ALL SELECT 'roc_auc', round(sum(neg * (tp - pos + pos / 2.0)) / (max(p) * max(n)), 6) FROM ({SUMS}) UNION ALL SELECT 'made_up', NULL""")
def evaluate(t, spark):
    return rounded(metrics.evaluate(binary(t), ["accuracy", "recall", "precision", "roc_auc", "made_up"]), 6).select("metric", "value")


@query(f"""WITH x AS (SELECT l_extendedprice AS y, l_quantity * 1000.0 + 500 AS s FROM lineitem), m AS ({MASKS}),
    px AS (SELECT unnest(pred) > 0.5 AS p, unnest(truth) > 0.5 AS t FROM m), k AS (SELECT sum(p::INTEGER) AS p, sum(t::INTEGER) AS t, sum((p AND t)::INTEGER) AS b FROM px)
    SELECT 'mse' AS metric, round(avg((y - s) ** 2), 2) AS value FROM x UNION ALL SELECT 'mae', round(avg(abs(y - s)), 2) FROM x
    UNION ALL SELECT 'r2_score', round(1 - avg((y - s) ** 2) / var_pop(y), 2) FROM x
    UNION ALL SELECT 'dice_score', round(2.0 * b / (p + t + 1e-6), 2) FROM k
    UNION ALL SELECT 'jaccard_index', round(CASE WHEN p + t - b = 0 THEN 0 ELSE b / (p + t - b) END, 2) FROM k""")
def default_metrics(t, spark):
    """What is measured by default for a regression, and for masks."""
    found = [metrics.evaluate(df, metrics.default_metrics(task)) for task, df in (("regression", prices(t)), ("segmentation", masks(t)))]
    return rounded(found[0].unionByName(found[1]), 2).select("metric", "value")


@query(f"WITH x AS ({BINARY}) SELECT 'accuracy' AS metric, round(avg((label = 1)::INTEGER) - avg((label = pred)::INTEGER), 6) AS loss FROM x")
def utility_loss(t, spark):
    good = metrics.evaluate(binary(t).withColumn("pred", F.lit(1)), ["accuracy"])
    return rounded(metrics.utility_loss(good, metrics.evaluate(binary(t), ["accuracy"])), 6)


# ---- losses


def _loss(name: str, table: str, sql: str, build) -> None:
    query(f"WITH x AS ({table}) SELECT round({sql}, 6) AS loss FROM x", name=name)(build)


LOG = "greatest(CASE WHEN {0} <= 0 THEN -100.0 ELSE ln({0}) END, -100.0)"
_P = "score"
_BCE = f"-(label * {LOG.format('score')} + (1 - label) * {LOG.format('(1 - score)')})".replace("ELSE ln(score)",
    "ELSE ln(nullif(greatest(score, 0), 0))").replace("ELSE ln((1 - score))", "ELSE ln(nullif(greatest(1 - score, 0), 0))")
_CE = "(list_max(scores) + ln(list_sum(list_transform(scores, lambda v: exp((v - list_max(scores))::DOUBLE)))) - scores[label + 1])"
_loss("bce_loss", BINARY, f"avg({_BCE})", lambda t, spark: rounded(losses.test_loss(binary(t), losses.bce_loss(F.col("score"), F.col("label"))), 6))
_loss("bce_logits_loss", BINARY, "avg(greatest(score - 0.5, 0) - (score - 0.5) * label + ln(1 + exp(-abs(score - 0.5))))", lambda t,
    spark: rounded(losses.test_loss(binary(t), losses.bce_logits_loss(F.col("score") - 0.5, F.col("label"))), 6))
_loss("l1_loss", BINARY, "avg(abs(score - label))", lambda t, spark: rounded(losses.test_loss(binary(t), losses.l1_loss(F.col("score"), F.col("label"))), 6))
_loss("cross_entropy", MULTI, f"avg({_CE})", lambda t, spark: rounded(losses.test_loss(multi(t), losses.cross_entropy(F.col("scores"), F.col("label"))), 6))
_loss("focal_loss", MULTI, f"avg(0.5 * (1 - exp(-{_CE})) ** 2 * {_CE})", lambda t, spark: rounded(losses.test_loss(multi(t), losses.focal_loss(F.col("scores"), F.col("label"), 0.5, 2.0)), 6))
_loss("composed_loss", BINARY, "avg(0.25 * abs(score - label) + (score - label) ** 2)", lambda t, spark: rounded(losses.test_loss(binary(t),
    losses.composed_loss("0.25 * l1 + d ** 2", {"l1": losses.l1_loss(F.col("score"), F.col("label")), "d": F.col("score") - F.col("label")})), 6))
_loss("test_loss", BINARY, "sum(abs(score - label))", lambda t, spark: rounded(losses.test_loss(binary(t), losses.l1_loss(F.col("score"), F.col("label")), "sum"), 6))


@query(f"""WITH m AS ({MASKS}), x AS (SELECT image_id, 1 / (1 + exp(-unnest(pred)::DOUBLE)) AS p, (unnest(truth) > 0.1)::INTEGER AS t FROM m)
    SELECT round(avg(l), 6) AS loss FROM (SELECT 1 - (2 * sum(p * t) + 1e-5) / (sum(p * p) + sum(t * t) + 1e-5) AS l FROM x GROUP BY image_id)""")
def soft_dice_loss(t, spark):
    return rounded(losses.test_loss(masks(t), losses.soft_dice_loss(F.col("pred"), c.binarize(F.col("truth"), 0.1))), 6)


# ---- privacy and policy

LINES = """SELECT l_orderkey AS id, l_linenumber, l_quantity / 10 AS eps,
    CASE WHEN l_tax > 0.04 THEN l_discount END AS delta, 's' || (l_suppkey % 5) AS owner, 'e' || (l_partkey % 3) AS endpoint, 'k' || (l_suppkey % 7) AS kid, l_returnflag, l_quantity
    FROM lineitem"""
STAGE = "SELECT o_orderkey AS run_id, o_orderkey AS id, o_orderstatus <> 'F' AS private, o_totalprice / 100000 AS epsilon FROM orders"


def contracts(t) -> DataFrame:
    """One contract per order: its lines are data sets with thresholds given as texts."""
    text = lambda prefix, column, n: F.concat(F.lit(prefix), (F.col(column) % n).cast("string"))
    lines = t("lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.struct(F.col("l_linenumber").cast("string").alias("id"), text("s", "l_suppkey", 5).alias("owner"), text("e", "l_partkey", 3).alias("endpoint"), text("k",
            "l_suppkey", 7).alias("kid")).alias("d"),
        F.struct(F.col("l_linenumber").cast("string").alias("dataset"), (F.col("l_quantity") / 10).cast("string").alias("epsilon_threshold"),
            F.when(F.col("l_tax") > 0.04, F.col("l_discount").cast("string")).alias("delta")).alias("p"),
    )
    return lines.groupBy("id").agg(F.collect_list("d").alias("datasets"), F.collect_list("p").alias("privacy"))  # a few lines an order


def runs(t) -> DataFrame:
    """One run per order: mounts of some of its lines, and a last stage from the order."""
    owner = F.concat(F.lit(audit.MOUNT_ROOT + "s"), (F.col("l_suppkey") % 5).cast("string"))
    mount = F.struct(owner.alias("mount_point"), (F.col("l_returnflag") == "R").alias("read_write"), F.concat(F.lit("e"),
        (F.col("l_partkey") % 3).cast("string")).alias("endpoint"), F.concat(F.lit("k"), (F.col("l_suppkey") % 7).cast("string")).alias("kid"))
    mounts = t("lineitem").filter("l_quantity > 5").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(mount).alias("mounts"))
    stage = F.struct(F.lit("train").alias("name"), (F.col("o_orderstatus") != "F").alias("is_private"), (F.col("o_totalprice") / 100000).alias("epsilon"), F.lit(None).cast("double").alias("delta"))
    staged = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("contract_id"), F.array(stage).alias("pipeline"))
    return staged.join(mounts, "id", "left")


@query(f"SELECT id, l_linenumber::VARCHAR AS dataset, round(eps, 4) AS epsilon, round(delta, 4) AS delta FROM ({LINES})")
def contract_explode(t, spark):
    return rounded(audit.contract_explode(contracts(t)))


BUDGET = f"SELECT id, min(eps) AS threshold, min(delta) AS delta FROM ({LINES}) GROUP BY 1"


@query(f"SELECT id, round(threshold, 4) AS epsilon, round(delta, 4) AS delta, CASE WHEN delta IS NULL THEN 'laplace' ELSE 'gaussian' END AS mechanism FROM ({BUDGET})")
def min_privacy_budget(t, spark):
    return rounded(audit.min_privacy_budget(contracts(t)))


@query("""SELECT o_orderkey, round(e / n, 6) AS per_tree, round(n * ln(1 + 0.8 * (exp(e / n) - 1)), 6) AS spent
    FROM (SELECT o_orderkey, o_totalprice / 100000 AS e, 50 + o_orderkey % 200 AS n FROM orders)""")
def epsilon_per_tree(t, spark):
    e, n = F.col("o_totalprice") / 100000, 50 + F.col("o_orderkey") % 200
    return t("orders").select("o_orderkey", r(audit.epsilon_per_tree(e, n), 6).alias("per_tree"), r(audit.epsilon_spent(e, n, F.lit(0.8)), 6).alias("spent"))


@query("SELECT o_custkey, round(least(0.2, 1.0 / n), 6) AS delta FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)")
def delta_clamp(t, spark):
    return t("orders").groupBy("o_custkey").count().select("o_custkey", r(audit.delta_clamp(F.lit(0.2), F.col("count")), 6).alias("delta"))


UNCOVERED = f"""SELECT o_orderkey AS run_id, a.l_linenumber::VARCHAR AS dataset FROM orders JOIN ({LINES}) a ON o_orderkey = a.id WHERE NOT EXISTS
    (SELECT 1 FROM ({LINES}) b WHERE b.id = a.id AND b.owner = a.owner AND b.endpoint = a.endpoint AND b.kid = a.kid AND b.l_returnflag <> 'R' AND b.l_quantity > 5)"""
MOUNTS = f"""SELECT o_orderkey AS run_id, count(DISTINCT owner)::INTEGER AS providers, sum((l_quantity > 5)::INTEGER)::INTEGER AS mounts
    FROM orders JOIN ({LINES}) ON o_orderkey = id GROUP BY 1"""
GATE = f"""SELECT run_id, epsilon, threshold,
    CASE WHEN threshold IS NULL THEN NOT private ELSE private AND epsilon <= threshold END AS ok FROM ({STAGE}) LEFT
    JOIN ({BUDGET}) USING (id)"""


@query(UNCOVERED)
def dataset_coverage(t, spark):
    return audit.dataset_coverage(contracts(t), runs(t))


@query(f"SELECT run_id, providers, mounts, mounts BETWEEN providers + 1 AND providers + 2 AS ok FROM ({MOUNTS})")
def mount_count_check(t, spark):
    return audit.mount_count_check(contracts(t), runs(t))


@query(f"SELECT run_id, round(epsilon, 7) AS epsilon, round(threshold, 7) AS threshold, ok FROM ({GATE})")
def budget_gate(t, spark):
    return rounded(audit.budget_gate(contracts(t), runs(t)), 7)


@query(f"""SELECT m.run_id, u.run_id IS NULL AS covered, m.mounts BETWEEN m.providers + 1 AND m.providers + 2 AS mounts_ok, g.ok AS budget_ok,
    u.run_id IS NULL AND m.mounts BETWEEN m.providers + 1 AND m.providers + 2 AND g.ok AS allowed
    FROM ({MOUNTS}) m JOIN ({GATE}) g ON m.run_id = g.run_id LEFT JOIN (SELECT DISTINCT run_id FROM ({UNCOVERED})) u ON u.run_id = m.run_id""")
def contract_audit(t, spark):
    return audit.contract_audit(contracts(t), runs(t))


# ---- model

FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query()
def score_table(t, spark):
    """Boosted trees that tell returned lines; fitted on two thirds, scored on the rest."""
    lines = t("lineitem").withColumns({"label": (F.col("l_returnflag") == "R").cast("int"), "id": F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")})
    fitted = model.gbt_baseline(lines.filter("l_orderkey % 3 <> 0"), FEATURES, "label", trees=5, depth=3)
    return model.score_table(fitted, lines.filter("l_orderkey % 3 = 0"), FEATURES, "id", "label")


# ---- image bytes

#: Bytes of three kinds of images: 8 x 8 grey, 2 x 11 in colour (two bytes of 0 at the end), 4 x 4 in colour with alpha.
BYTES = """SELECT vec_id, [8, 2, 4][vec_id % 3 + 1] AS h, [8, 11, 4][vec_id % 3 + 1] AS w, [1, 3, 4][vec_id % 3 + 1] AS c,
    list_concat(list_transform(embedding, lambda x: abs(floor(x::DOUBLE * 1000))::BIGINT % 256), [0, 0]) AS b FROM embeddings"""
PIXEL = "b[1 + (k % (h * w)) * c + CASE WHEN c = 1 THEN 0 ELSE [2, 1, 0, 3][k // (h * w) + 1] END]"


def image_bytes(t):
    kind = (F.col("vec_id") % 3 + 1).cast("int")
    pick = lambda *of: F.element_at(F.array(*[F.lit(x) for x in of]), kind)
    value = F.transform("embedding", lambda x: F.lpad(F.hex(F.abs(F.floor(x.cast("double") * 1000)).cast("long") % 256), 2, "0"))
    data = F.unhex(F.concat(F.array_join(value, ""), F.when(kind == 2, "0000").otherwise("")))
    return t("embeddings").select("vec_id", pick(8, 2, 4).alias("height"), pick(8, 11, 4).alias("width"), pick(1, 3, 4).alias("channels"), data.alias("data"))


IMAGE = [F.col, ("data", "height", "width", "channels")]


@query(f"SELECT vec_id, k::INTEGER AS place, round({PIXEL} / 255.0, 4) AS value FROM (SELECT *, unnest(range(0, h * w * c)) AS k FROM ({BYTES}))")
def image_tensor(t, spark):
    tensor = tensor_of(*map(*IMAGE))
    return image_bytes(t).select("vec_id", F.posexplode(tensor["values"]).alias("place", "value")).select("vec_id", "place", r(F.col("value").cast("double")).alias("value"))


@query(f"""SELECT vec_id, p::INTEGER AS place, luma::INTEGER AS luma, (luma / 255.0 > 0.5)::INTEGER AS over FROM (SELECT vec_id, p,
    CASE WHEN c = 1 THEN b[1 + p] ELSE (299 * b[p * c + 3] + 587 * b[p * c + 2] + 114 * b[p * c + 1] + 500) // 1000 END AS luma FROM (SELECT *, unnest(range(0, h * w)) AS p FROM ({BYTES})))""")
def image_grayscale(t, spark):
    """Luma of whole pixels, and whether it is over a half."""
    both = image_bytes(t).select("vec_id", tensor_of(*map(*IMAGE), grayscale=True, unit=False).alias("g"), tensor_of(*map(*IMAGE), grayscale=True, threshold=0.5).alias("o"))
    each = both.select("vec_id", F.posexplode(F.arrays_zip(F.col("g.values").alias("luma"), F.col("o.values").alias("over"))).alias("place", "p"))
    return each.select("vec_id", "place", F.col("p.luma").cast("int").alias("luma"), F.col("p.over").cast("int").alias("over"))


# ---- folders


@query("""SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS relative_path, CASE WHEN o_orderstatus = 'P' THEN 'second' ELSE 'first' END AS provider, 'folder' AS kind FROM orders
    UNION ALL SELECT '', 'third', 'missing'""")
def folder_union(t, spark):
    """Folders that two providers have written by order status, and a provider without any; the first has no folder of status P."""
    root = new_folder(spark, "tables")
    o = t("orders").select("o_orderkey", "o_orderstatus")
    for name, df in (("first", o.filter("o_orderstatus <> 'P'")), ("second", o)):
        df.write.partitionBy("o_orderstatus").parquet(f"{root}/{name}")
    listed = folders.list_folders(spark, {name: f"{root}/{name}" for name in ("first", "second", "third")})
    return folders.folder_union(listed, ["first", "second", "third"]).filter("kind <> 'file'").select("relative_path", "provider", "kind")


# ---- features as an array

PLACES = "SELECT vec_id, unnest(range(0, 64))::INTEGER AS place, unnest(embedding)::DOUBLE AS x FROM embeddings"


def _scaled(t, method: str) -> DataFrame:
    done = vectors.scale_features(t("embeddings").select("vec_id", "embedding"), "embedding", method, F.expr("vec_id % 4 <> 0"))
    return done.select("vec_id", F.posexplode("embedding").alias("place", "x")).select("vec_id", "place", r("x").alias("x"))


def _array_scaler(method: str, shift: str, width: str) -> None:
    query(f"""WITH e AS ({PLACES}), f AS (SELECT place, {shift} AS a, {width} AS b FROM e WHERE vec_id % 4 <> 0 GROUP BY 1)
    SELECT vec_id, place, round((x - a) / CASE WHEN b = 0 THEN 1 ELSE b END + {NUDGE}, 4) + 0.0 AS x FROM e JOIN f USING (place)""", name=f"scale_array_{method}")(lambda t, spark: _scaled(t, method))


_array_scaler("standard", "avg(x)", "stddev_pop(x)")
_array_scaler("minmax", "min(x)", "max(x) - min(x)")
_array_scaler("robust", "quantile_cont(x, 0.5)", "quantile_cont(x, 0.75) - quantile_cont(x, 0.25)")


@query(f"""WITH f AS (SELECT place, min(x) AS least, max(x) AS most FROM ({PLACES}) GROUP BY 1)
    SELECT place::VARCHAR AS feature, round(least, 4) AS least, round(most, 4) AS most FROM f UNION ALL SELECT 'mean', round(avg(least), 4) AS least, round(avg(most), 4) AS most FROM f""")
def feature_bounds_array(t, spark):
    """The bounds of each feature of an array, and the means of the bounds."""
    found = vectors.bounds(t("embeddings"), "embedding")
    both = found.withColumn("feature", F.col("feature").cast("string")).unionByName(vectors.mean_bounds(found).withColumn("feature", F.lit("mean")))
    return both.select("feature", r("least").alias("least"), r("most").alias("most"))


@query("""SELECT o_orderkey, round(o_totalprice + 10 * (o_orderstatus = 'F')::INTEGER + 100 * (o_orderstatus = 'O')::INTEGER + 1000 * (o_orderstatus = 'P')::INTEGER, 2) AS total, 5 AS size FROM orders""")
def build_matrix_array(t, spark):
    """A number, three ones and the place for missing values, as one array."""
    wide_, names = encode.build_matrix(t("orders"), {"o_orderstatus": "one_hot"}, ["o_totalprice"], ["o_orderkey"])
    arrays = vectors.assembled(wide_, names, ["o_orderkey"])
    weights = F.array(*[F.lit(float(x)) for x in (1, 10, 100, 1000, 10_000)])
    return arrays.select("o_orderkey", r(F.aggregate(F.zip_with("features", weights, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x), 2).alias("total"), F.size("features").alias("size"))


@query(f"""SELECT split, count(*) AS n_rows, 5 AS n_features, 4 AS total_features, 1 AS numerical_features, 1 AS categorical_features, 3 AS encoded_features FROM (SELECT
    CASE WHEN k <= test THEN 'test' WHEN k <= test + val THEN 'val' ELSE 'train' END AS split FROM ({SIZED} ({RANKED}))) GROUP BY 1""")
def split_feature_kinds(t, spark):
    """Splits of a matrix of one number and one text column, with how many features there are of each kind."""
    kinds = {"status": "one_hot"}
    own = t("orders").select("o_orderkey", "o_totalprice", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    matrix, names = encode.build_matrix(own, kinds, ["o_totalprice"], ["o_orderkey"])
    return split.split_summary(split.split_exact(matrix, ["o_orderkey"], RATIOS), vectors.feature_kinds(["o_totalprice"], kinds, names))


# ---- losses of two levels, trees, curves, hot links, volumes


def _composed(t, reduction: str) -> DataFrame:
    parts = {"bce": losses.Loss(losses.bce_loss(F.col("score"), F.col("label"))), "l1": losses.Loss(losses.l1_loss(F.col("score"), F.col("label"))), "dice": losses.soft_dice_of_set(F.col("score"), F.col("label"))}
    inner = {"expression": "(bce + l1) * w", "components": {"bce": "bce", "l1": "l1"}, "variables": {"w": 0.25}, "reduction": reduction}
    config = {"expression": "dice + half * bce - inner / (1 + dice)", "components": {"dice": "dice", "bce": "bce", "inner": inner}, "variables": {"half": 0.5}, "reduction": reduction}
    return rounded(losses.test_loss(binary(t), losses.composed(config, parts)), 4)


def _composed_sql(times: str, reduce: str) -> str:
    return f"""WITH x AS ({BINARY}), s AS (SELECT 1 - (2 * sum(score * label) + 1e-5) / (sum(score * score) + sum(label * label) + 1e-5) AS dice, {reduce}({_BCE}) AS bce, {reduce}(abs(score - label)) AS l1, count(*) AS n FROM x)
    SELECT round({times} * dice + 0.5 * bce - {times} * (0.25 * (bce + l1)) / (1 + dice), 4) AS loss FROM s"""


query(_composed_sql("1", "avg"), name="composed_loss_mean")(lambda t, spark: _composed(t, "mean"))
query(_composed_sql("n", "sum"), name="composed_loss_sum")(lambda t, spark: _composed(t, "sum"))

#: Borders of l_quantity and l_discount, and the second-order gains of a split at each, with l2 = 1.
CUTS = {"l_quantity": [5.0 * k for k in range(1, 10)], "l_discount": [0.01 * k for k in range(1, 10)]}
_SIDES = " UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature, {b!r}::DOUBLE AS border, sum(g) FILTER ({c} <= {b!r}) AS gl, sum(h) FILTER ({c} <= {b!r}) AS hl, sum(g) AS g, sum(h) AS h FROM s" for i, (c, cuts) in enumerate(CUTS.items()) for b in cuts)


@query(f"""WITH s AS (SELECT l_quantity, l_discount, 0.5 - (l_returnflag = 'R')::INTEGER AS g, 0.25 AS h FROM lineitem),
    x AS (SELECT *, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain FROM ({_SIDES}) WHERE hl >= 1 AND h - hl >= 1)
    SELECT feature, round(border, 4) AS border, round(gain, 4) AS gain, round(-gl / (hl + 1) * 0.1, 6) AS left_value, round(-(g - gl) / (h - hl + 1) * 0.1, 6) AS right_value
    FROM x ORDER BY gain DESC, f, border LIMIT 1""")
def tree_split(t, spark):
    """The first split of a second-order tree that tells returned lines, and the leaves below it."""
    lines = t("lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    fitted = trees.fit(lines, list(CUTS), "label", trees=1, depth=1, borders=list(CUTS.values()))
    top, left, right = (trees.table(fitted)[k] for k in range(3))
    return rounded(spark.createDataFrame([(top[2], top[3], top[4], left[5], right[5])], "feature string, border double, gain double, left_value double, right_value double")).drop("left_value", "right_value").withColumns(
        {"left_value": F.round(F.lit(left[5]), 6), "right_value": F.round(F.lit(right[5]), 6)})


@query()
def tree_scores(t, spark):
    """Second-order trees that tell returned lines; fitted on two thirds, scored on the rest."""
    lines = t("lineitem").withColumns({"label": (F.col("l_returnflag") == "R").cast("int"), "id": F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")})
    fitted = trees.fit(lines.filter("l_orderkey % 3 <> 0"), FEATURES, "label", trees=3, depth=3)
    return trees.score_table(fitted, lines.filter("l_orderkey % 3 = 0"), "id", "label")


@query(f"""WITH x AS ({BINARY}), g AS (SELECT *, lead(pos) OVER (ORDER BY score DESC) AS np, lead(neg) OVER (ORDER BY score DESC) AS nn FROM ({SUMS}))
    SELECT round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr, round(score, 6) AS threshold FROM g WHERE np IS NULL OR np <> pos OR nn <> neg UNION ALL SELECT 0.0, 0.0, 'inf'::DOUBLE""")
def roc_curve_corners(t, spark):
    return rounded(metrics.roc_curve(binary(t), drop_collinear=True), 6)


@query("SELECT c_nationkey AS nation, count(*) AS n, sum(s_suppkey * c_custkey)::BIGINT AS total FROM customer JOIN supplier ON c_nationkey = s_nationkey GROUP BY 1")
def link_dealt(t, spark):
    """Customers and suppliers of a nation, each key cut into blocks."""
    a, b = t("customer").select(F.col("c_nationkey").alias("nation"), "c_custkey"), t("supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey")
    return link.link_dealt(a, b, "nation", pairs_a_task=16).groupBy("nation").agg(F.count("*").alias("n"), F.sum(F.col("s_suppkey").cast("long") * F.col("c_custkey")).alias("total"))


@query(f"""WITH m AS ({MASKS}), x AS (SELECT image_id, unnest(range(0, 64)) AS i, unnest(pred) > 0.1 AS p, unnest(truth) > 0.1 AS t FROM m),
    d AS (SELECT a.image_id, a.i AS ai, b.i AS bi, sqrt((a.i // 16 - b.i // 16) ** 2 + (a.i // 4 % 4 - b.i // 4 % 4) ** 2 + (a.i % 4 - b.i % 4) ** 2) AS d FROM x a JOIN x b ON a.image_id = b.image_id AND a.p AND b.t),
    f AS (SELECT image_id, max(v) AS v FROM (SELECT image_id, min(d) AS v FROM d GROUP BY image_id, ai UNION ALL SELECT image_id, min(d) FROM d GROUP BY image_id, bi) GROUP BY 1)
    SELECT image_id, round(coalesce(v, 'inf'::DOUBLE), 6) AS distance FROM (SELECT image_id FROM m) LEFT JOIN f USING (image_id)""")
def hausdorff_volume(t, spark):
    """Volumes of 4 x 4 x 4."""
    return rounded(metrics.hausdorff_each(masks(t).withColumn("shape", F.array(*[F.lit(4)] * 3)), 0.1), 6)
