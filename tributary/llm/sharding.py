"""Sharding by histogram sort, under the law `bytes`.

Method. Rows are ordered by a 64-bit key: the leading TEXT_BITS bits of the text's hash, then ID_BITS of the doc_id's hash, then bits of a hash of the row's own number,
so that equal texts lie together and a large group of them can still be cut, also where its rows share one doc_id or have none. The first round counts rows and exact bytes
in 2^FIRST_BITS cells of the key space; each further round refines the cells that hold a splitter and too many bytes, or
too many rows, into 2^NEXT_BITS smaller ones. Only these counts come to the driver: at most CELLS_FOR_ROWS + shards
cells are refined in a round, whatever the input. When the splitters are within tolerance, every cell belongs to one
shard and has a known place in it, and the rows are exchanged once, by cell, to get their slots. Each shard thus takes
many tasks to fill, not one.

Defined results. Size is the number of UTF-8 bytes plus 1; a null text has size 1 and a null checksum, an empty one size 1
and checksum 0. Shard sizes differ from each other by about TOLERANCE of a shard, or by the largest row if that
is more. Slots count from 0 without gaps within a shard, in key order, then doc_id, nulls first; rows that repeat both text
and doc_id are interchangeable. No rows give no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.shared import saved

FIRST_BITS, NEXT_BITS, TEXT_BITS, ID_BITS, KEY_BITS = 12, 6, 18, 22, 60
#: A cell with more than 1 / CELLS_FOR_ROWS of the rows is refined, so that no task gets more.
CELLS_FOR_ROWS = 512
TOLERANCE = 0.001


def _prefix(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, KEY_BITS - bits)


def _counts(rows: DataFrame, cell: Column) -> list[tuple[int, int, int]]:
    found = rows.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    return sorted((r["cell"], r["n"], r["bytes"]) for r in found.collect())


def cells(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int, int, int]]:
    """Leaf cells in key order: (bits, prefix, rows, bytes). rows: key, size."""
    leaves = [(FIRST_BITS, c, n, b) for c, n, b in _counts(rows, _prefix(F.col("key"), FIRST_BITS))]
    total, most_rows = sum(x[3] for x in leaves), max(1, sum(x[2] for x in leaves) // CELLS_FOR_ROWS)
    bits = FIRST_BITS
    while bits + NEXT_BITS <= KEY_BITS:
        below, wide = 0, []
        for leaf in leaves:
            ends = (below * shards // max(total, 1), (below + leaf[3]) * shards // max(total, 1))
            splitter_inside = ends[0] != ends[1] and leaf[3] * shards > tolerance * total
            if leaf[0] == bits and leaf[2] > 1 and (leaf[2] > most_rows or splitter_inside):
                wide.append(leaf[1])
            below += leaf[3]
        if not wide:
            break
        inside = rows.filter(_prefix(F.col("key"), bits).isin(wide))
        finer = [(bits + NEXT_BITS, c, n, b) for c, n, b in _counts(inside, _prefix(F.col("key"), bits + NEXT_BITS))]
        leaves = [x for x in leaves if x[0] != bits or x[1] not in set(wide)] + finer
        leaves.sort(key=lambda x: x[1] << (KEY_BITS - x[0]))
        bits += NEXT_BITS
    return leaves


def placed(leaves: list[tuple[int, int, int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """(bits, prefix, shard, first slot) of each leaf; a cell goes to the shard in which its middle byte falls."""
    total, below, slots, out = sum(x[3] for x in leaves), 0, [0] * shards, []
    edges = [total * (j + 1) / shards for j in range(shards - 1)]
    for bits, prefix, n, size in leaves:
        shard = bisect_right(edges, below + size / 2)
        out.append((bits, prefix, shard, slots[shard]))
        slots[shard] += n
        below += size
    return out


def shard_by_bytes(docs: DataFrame, shards: int = 16, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.col("text").cast("string")

    def bits(value: Column, n: int, above: int) -> Column:
        """The leading n bits of a hash, placed below the key's first `above` bits."""
        return F.shiftleft(F.shiftrightunsigned(value, 64 - n), KEY_BITS - above - n)

    key = bits(F.xxhash64(text), TEXT_BITS, 0).bitwiseOR(bits(F.xxhash64(F.col("doc_id"), F.lit("place")), ID_BITS, TEXT_BITS))
    key = key.bitwiseOR(bits(F.xxhash64(F.monotonically_increasing_id()), KEY_BITS - TEXT_BITS - ID_BITS, TEXT_BITS + ID_BITS))
    rows = saved(
        docs.select(
            F.col("doc_id").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            key.alias("key"),
        )
    )
    places = placed(cells(rows, shards, tolerance), shards)
    spark = docs.sparkSession
    # one lookup by (bits, prefix) for each depth in use; the table is bounded by the rounds, so it is broadcast
    depths = sorted({p[0] for p in places}) or [FIRST_BITS]
    table = spark.createDataFrame(places, "bits int, prefix long, shard int, first long")
    keys = F.explode(F.array(*[F.struct(F.lit(d).alias("bits"), _prefix(F.col("key"), d).alias("prefix")) for d in depths]))
    dealt = rows.select("*", keys.alias("p")).select("*", "p.*").drop("p").join(F.broadcast(table), ["bits", "prefix"])
    order = Window.partitionBy("bits", "prefix").orderBy("key", "doc_id")
    slot = F.col("first") + F.row_number().over(order) - 1
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
