"""Linking tables on shared keys, and what is done to the columns of the result."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions.columns import base_name, filled_pattern, strip_affixes
from tributary.operators.deidentify import EMPTY_HASH
from tributary.plans.lineage import saved

_FORBIDDEN = {"insert", "update", "delete", "drop", "alter", "create", "truncate", "merge", "grant", "revoke", "replace", "call", "set", "use", "load", "cache", "uncache", "refresh"}


def query_guard(query: str) -> str:
    """The query, if it is one statement that only reads.

    Words are looked at outside quotes and names in back ticks, so a column named last_update passes and a literal may hold anything.
    """
    if not isinstance(query, str) or not query.strip():
        raise ValueError("a query text is asked for")
    bare = re.sub(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`", " ", query)
    if ";" in bare:
        raise ValueError("more than one statement")
    words = re.findall(r"[A-Za-z_]\w*", bare.lower())
    called = set(re.findall(r"([A-Za-z_]\w*)\s*\(", bare.lower()))
    if not words or words[0] not in {"select", "with", "from", "values", "table"}:
        raise ValueError("not a query")
    if found := (set(words) & _FORBIDDEN) - (called & {"replace", "set"}):
        raise ValueError(f"not allowed in a query: {', '.join(sorted(found))}")
    return query


def refuse_products(df: DataFrame) -> DataFrame:
    """`df`, unless it joins two tables without an equality between them: then every row of one would meet every row of the other."""
    for node in _nodes(df._jdf.queryExecution().sparkPlan()):
        if node.nodeName() in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            raise ValueError("a join without a condition of equality between its sides")
    return df


#: What an analysed query may be made of: names of Catalyst's logical operators.
NODES = {
    "Project", "Filter", "Join", "LateralJoin", "Aggregate", "Window", "Sort", "Distinct", "Deduplicate", "Union", "Intersect", "Except", "SubqueryAlias", "View", "GlobalLimit", "LocalLimit", "Limit", "Offset", "Tail",
    "WithCTE", "CTERelationDef", "CTERelationRef", "UnionLoop", "UnionLoopRef", "LocalRelation", "OneRowRelation", "Generate", "Expand", "Pivot", "Unpivot", "Sample", "ResolvedHint", "UnresolvedHint", "SubqueryColumnAliases", "Range",
}
#: And the packages that its expressions come from; functions of the session's users and of Java live elsewhere, or are named below.
EXPRESSIONS = re.compile(r"^org\.apache\.spark\.sql\.catalyst\.(expressions|analysis)\.")
#: Expressions of those packages that call code by its name, run code of a user, or tell of the machine and its files.
CALLS = re.compile(
    r"Reflection|Reflect|^(Try)?Invoke$|^StaticInvoke$|UDF|UDAF|^Python|UserDefined|^TypedFilter|^MapObjects|^NewInstance|^Unresolved|^InputFile|^Current(User|Catalog|Database)|^SparkVersion|^Version"
)


def _each(seq):
    """The elements of a Scala sequence."""
    found = seq.iterator()
    while found.hasNext():
        yield found.next()


def _nodes(plan):
    """A plan's nodes, those of its subqueries and inner plans among them."""
    open_ = [plan]
    while open_:
        node = open_.pop()
        yield node
        open_ += [*_each(node.children()), *_each(node.subqueries())]


def _short(node) -> str:
    return node.getClass().getName().rsplit(".", 1)[-1]


def _refuse_calls(expression) -> None:
    """Walk an expression down to its leaves. What a function of SQL is made of (its replacement) is Spark's own choice and isn't looked at, but its arguments are."""
    open_ = [expression]
    while open_:
        e = open_.pop()
        name = e.getClass().getName()
        if not EXPRESSIONS.match(name) or CALLS.search(name.rsplit(".", 1)[-1]):
            raise ValueError(f"a query may not call into the JVM or a user's code: {name.rsplit('.', 1)[-1]}")
        open_ += list(_each(e.children()))


def refuse_foreign(df: DataFrame, views: list[str]) -> DataFrame:
    """`df`, unless its analysed plan holds something other than NODES over the given views (other tables, files named by path, commands), or calls into the JVM.

    The tree itself is walked, with all expressions of a node and the plans of its subqueries. What stands below one of the views was made by the caller and isn't looked at.
    """
    open_ = [df._jdf.queryExecution().analyzed()]
    while open_:
        node = open_.pop()
        name = _short(node)
        if name == "View" and node.desc().identifier().table() in views:
            continue
        if name not in NODES:
            raise ValueError(f"a query may read the tables of its own run only, and may not hold {name}")
        for e in _each(node.expressions()):
            _refuse_calls(e)
        open_ += [*_each(node.children()), *_each(node.subqueries())]
        if name == "WithCTE":
            open_ += list(_each(node.cteDefs()))
    return df


def drop_index_column(df: DataFrame) -> DataFrame:
    """Without the unnamed first CSV column, which Spark names _c0."""
    return df.drop("_c0")


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Of columns with one name the first stays."""
    places = [f"c{i}" for i in range(len(df.columns))]
    first = {}
    for place, name in zip(places, df.columns, strict=True):
        first.setdefault(name, place)
    return df.toDF(*places).select(*[F.col(place).alias(name) for name, place in first.items()])


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Without the named columns; unknown names are ignored."""
    return df.drop(*names)


def remove_identifiers(df: DataFrame, identifiers: list[str]) -> DataFrame:
    return df.drop(*identifiers)


def select_variables(df: DataFrame, wanted: list[str], keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Keys and wanted columns that exist, and the wanted names that don't."""
    return df.select(*[c for c in df.columns if c in keys or c in wanted]), [c for c in wanted if c not in df.columns]


def check_result_columns(df: DataFrame, expected: list[str]) -> dict[str, list[str]]:
    """Columns that are missing, and extra ones, which may be identifiers that were not removed."""
    return {"missing": sorted(set(expected) - set(df.columns)), "extra": sorted(set(df.columns) - set(expected))}


def prune_available(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the table's order."""
    return df.select(*[c for c in df.columns if c in set(wanted)])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def without_missing_key(df: DataFrame, key: str) -> DataFrame:
    """Rows whose hashed key stands for a value: the hash of a missing key would join all missing keys with each other."""
    return df.filter(F.col(key).isNotNull() & (F.col(key) != EMPTY_HASH))


def key_multiplicity(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """source, n_keys, most, missing: how often keys repeat in each table, before they are linked; n rows a side fan out to their product."""
    out = None
    for name, df in tables.items():
        counts = df.groupBy(key).agg(F.count("*").alias("n"))
        unset = F.col(key).isNull() | (F.col(key).cast("string") == EMPTY_HASH)
        row = counts.agg(F.lit(name).alias("source"), F.count_if(~unset).alias("n_keys"), F.max(F.when(~unset, F.col("n"))).alias("most"), F.coalesce(F.sum(F.when(unset, F.col("n"))), F.lit(0)).alias("missing"))
        out = row if out is None else out.unionByName(row)
    return out


def inner_link(tables: list[DataFrame], key: str) -> DataFrame:
    """Inner equi-join of several tables on one key; each table is exchanged once, as all joins share the key."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, key)
    return out


#: Pairs of rows that one task makes of a key, and hot keys that are dealt out, the hottest first, as their table is broadcast.
PAIRS_A_TASK, HOT_KEYS = 4_000_000, 100_000
#: Pairs of blocks that all pairs of the hot keys are dealt to, about. A row is copied for every block it meets; past that number blocks grow instead of copies, so that these grow no faster than the rows.
BLOCK_PAIRS = 1_000


def hot_keys(left: DataFrame, right: DataFrame, key: str, pairs_a_task: int = PAIRS_A_TASK, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """key, left_blocks, right_blocks: keys that would give more pairs than that, and into how many blocks the rows of either side are cut.

    Blocks of either side hold about as many rows, so no pair of blocks gives more than pairs_a_task pairs or, where that is more, its share of all pairs of the hot keys in block_pairs.
    Rows are copied (1 + sqrt(block_pairs)) times at most, over all: with p pairs a pair of blocks, n x m pairs of a key need n + m + 2 x n x m / sqrt(p) copies.
    """
    n, m = (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(name)) for df, name in ((left, "n"), (right, "m")))
    both = n.join(m, key).withColumn("pairs", F.col("n").cast("double") * F.col("m")).filter(F.col("pairs") > pairs_a_task)
    hottest = both.orderBy(F.desc("pairs"), key).limit(HOT_KEYS)  # few enough for a window over all of them
    side = F.sqrt(F.greatest(F.lit(float(pairs_a_task)), F.sum("pairs").over(Window.partitionBy(F.lit(0))) / block_pairs))
    blocks = lambda c: F.greatest(F.ceil(F.col(c) / side), F.lit(1)).cast("int")
    return hottest.select(key, blocks("n").alias("left_blocks"), blocks("m").alias("right_blocks"))


def link_dealt(left: DataFrame, right: DataFrame, key: str, pairs_a_task: int = PAIRS_A_TASK, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Inner equi-join whose hot keys are dealt out block against block.

    Keys are counted on both sides first. A row of a hot key goes to one block of its side, by a hash of its columns, and meets every block of the other side: (block, block) is
    part of the join key, so the pairs of one key are made by many tasks, each pair once. Rows of other keys are in block 0 and stay as they are. Equal rows share a block.
    Beyond HOT_KEYS hot keys the coolest of them aren't cut, and still join.
    """
    hot = F.broadcast(saved(hot_keys(left, right, key, pairs_a_task, block_pairs)))
    both = ("left_blocks", "right_blocks")

    def side(df: DataFrame, own: str, other: str, own_at: str, other_at: str) -> DataFrame:
        known = df.join(hot, key, "left")
        block = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.coalesce(own, F.lit(1))).cast("int")
        meets = F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)
        return known.withColumn(own_at, block).withColumn(other_at, F.explode(meets)).drop(*both)

    one, two = side(left, *both, "__i", "__j"), side(right, *both[::-1], "__j", "__i")
    return one.join(two, [key, "__i", "__j"]).drop("__i", "__j")


def left_star(base: DataFrame, others: list[DataFrame], key: str) -> DataFrame:
    """The base with each other table attached on the key; of columns with one name the leftmost stays."""
    out, seen = base, set(base.columns)
    for t in others:
        out = out.join(t.select(key, *[c for c in t.columns if c not in seen]), key, "left")
        seen |= set(t.columns)
    return out


def link_tables(
    spark: SparkSession, tables: dict[str, DataFrame], query: str, drop: list[str] = (), identifiers: list[str] = (), distinct_inputs: bool = False, without_missing: list[str] = (),
) -> DataFrame:
    """Run a guarded join query over named tables; then full-row distinct, first-named columns, drop columns and identifiers.

    The query may read these tables only, and each join needs an equality between its sides.
    distinct_inputs: the caller states that inputs hold no equal rows and the query keeps all their columns; a join of
    such inputs is distinct, so the wide exchange is left out. Identifiers are removed before anything is written.
    without_missing: hashed keys whose missing values are left out of every table that has them, as they would all match each other.
    """
    tag = uuid.uuid4().hex[:8]
    query_guard(query)
    for name, df in tables.items():
        for key in without_missing:
            df = without_missing_key(df, key) if key in df.columns else df
        df.createOrReplaceTempView(f"{name}_{tag}")
    try:
        found = refuse_foreign(spark.sql(_aliased(query, list(tables), tag)), [f"{name}_{tag}" for name in tables])
        return _clean(found, drop, identifiers, distinct_inputs)
    finally:
        for name in tables:
            spark.catalog.dropTempView(f"{name}_{tag}")


def _aliased(query: str, names: list[str], tag: str) -> str:
    """The query over the run's own views, each known by its plain name in a leading WITH."""
    views = ", ".join(f"`{n}` AS (SELECT * FROM `{n}_{tag}`)" for n in names)
    if begin := re.match(r"(?i)\s*with\b(\s+recursive\b)?", query):
        return f"WITH{begin.group(1) or ''} {views},{query[begin.end():]}"
    return f"WITH {views} {query}"


def _clean(df: DataFrame, drop: list[str], identifiers: list[str], distinct_inputs: bool) -> DataFrame:
    df = drop_index_column(refuse_products(df))
    if not distinct_inputs:
        df = distinct_rows(df)
    return remove_identifiers(drop_columns(drop_duplicate_columns(df), list(drop)), list(identifiers))


def first_wins(df: DataFrame, key: str, priority: str) -> DataFrame:
    """The row with the smallest priority of each key, kept by a partial aggregate."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*others), priority).alias("r")).select(key, "r.*")


def directory_union(files: DataFrame, providers: list[str]) -> DataFrame:
    """files (provider, relative_path, ...): one row per relative path, of the provider named first."""
    rank = F.array_position(F.array(*[F.lit(p) for p in providers]), F.col("provider"))
    return first_wins(files.withColumn("priority", rank).filter("priority > 0"), "relative_path", "priority")


_GLOB = re.compile(r"\*|\?|\[!?[^\]]+\]|\{id\}")


def _pieces(pattern: str) -> list[str]:
    """A pattern cut into wildcards and the texts between them."""
    out, at = [], 0
    for m in _GLOB.finditer(pattern):
        out += [pattern[at : m.start()], m.group()]
        at = m.end()
    return [x for x in [*out, pattern[at:]] if x]


def _one_name(piece: str) -> str | None:
    """A wildcard within a name as a regular expression; None for texts, `*` and {id}."""
    if piece == "?":
        return "[^/]"
    if piece.startswith("[") and piece.endswith("]") and len(piece) > 2:
        return "[^/" + re.sub(r"([\\\[&^])", r"\\\1", piece[2:-1]) + "]" if piece[1] == "!" else "[" + re.sub(r"([\\\[&^])", r"\\\1", piece[1:-1]) + "]"
    return None


def glob_regex(pattern: str) -> str:
    """An anchored regular expression for a glob over one or more names of a path: *, ?, [abc], [!abc]."""
    return "^" + "".join("[^/]*" if x == "*" else _one_name(x) or re.escape(x) for x in _pieces(pattern)) + "$"


def _name_regex(pattern: str, folder: Column) -> Column:
    """For each row, an anchored regular expression for a file name: `*` stands for the folder's name, {id} for any text, captured."""
    quoted = F.regexp_replace(folder, r"([^\p{L}\p{N}_])", r"\\$1")
    parts = [quoted if x == "*" else F.lit("([^/]*)") if x == "{id}" else F.lit(_one_name(x) or re.escape(x)) for x in _pieces(pattern)]
    return F.concat(F.lit("(?s)^"), *parts, F.lit("$"))


def pair_files(files: DataFrame, folder_pattern: str, input_pattern: str, target_pattern: str, remove_prefix: str = "", remove_suffix: str = "") -> DataFrame:
    """files (path): folder, id, input_path, target_path of each input whose target exists in the same folder.

    folder_pattern is a glob over the folder's name (or its last names, if it holds slashes). In the file patterns `*` is the folder's name and {id} the identifier; `?` and
    [abc] stand for one character of an input's name. The identifier is what {id} matches in the input's name; without {id} there, it is the whole name without the texts
    remove_prefix and remove_suffix. The target's whole name is the target pattern with both filled in, and joined as text: characters that
    mean something in regular expressions stand for themselves.
    """
    if input_pattern.count("{id}") > 1:
        raise ValueError("one {id} in an input's pattern")
    depth = folder_pattern.count("/") + 1
    place = F.regexp_extract("path", r"(?s)^(.*)/[^/]*$", 1)
    own = files.select("path", base_name(F.col("path")).alias("name"), place.alias("place")).withColumn("folder", base_name(F.col("place")))
    own = own.filter(F.substring_index("place", "/", -depth).rlike(glob_regex(folder_pattern)))
    pattern = _name_regex(input_pattern, F.col("folder"))
    inputs = own.withColumn("__pattern", pattern).filter(F.expr("name rlike __pattern"))
    identifier = F.expr("regexp_extract(name, __pattern, 1)") if "{id}" in input_pattern else strip_affixes(F.col("name"), remove_prefix, remove_suffix)
    asked = inputs.select("place", "folder", identifier.alias("id"), F.col("path").alias("input_path"))
    asked = asked.withColumn("name", filled_pattern(target_pattern, F.col("folder"), F.col("id")))
    return asked.join(own.select("place", "name", F.col("path").alias("target_path")), ["place", "name"]).select("folder", "id", "input_path", "target_path")
