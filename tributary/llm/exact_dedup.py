"""Exact deduplication with Patricia-trie owners.

Method. Texts are compared without white space. Rows are dealt out by length and leading bits of the content hash, and the full
byte strings of a partition are inserted into one compressed radix trie; a terminal node stores the owner (the smallest
identifier under the order below) and the number of rows. The same is done first within each task's own rows, so that a text leaves a
task once however many copies it has there. Rows of a partition come ordered by length and hash bits: where one such bucket ends,
all its texts are done, and a trie that has grown enough is emitted and begun anew. A bucket that is too large for a task's memory spills by
subtree: a heavy subtree's texts, and whatever comes later below its first byte, are passed on as rows to another exchange, by
more bits of the hash. Nothing goes to a local folder. The table is read once: narrow rows of all documents pass through the
same exchange, and are joined with the owners afterwards.

Defined results. A null text counts as empty, and all empty texts are one group. Of equal texts the one with the most
code points before white space is deleted is the owner, then the smallest doc_id, null after all others. Rows that repeat a doc_id
with an equal text and length count in group_size each, but only one of them is kept. No input rows give no output rows. A very long text is one
key; it is held once by a task, whatever the budget. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.shared import join_many, saved, small_batches, stripped

#: Bytes that one task holds in a trie before it emits or spills.
TRIE_BYTES = 64_000_000
#: What a node takes besides its bytes, roughly.
NODE_BYTES = 400
#: Bits of the hash by which rows are dealt out, besides their length, and how many more each time a bucket spills.
FIRST_BITS, MORE_BITS, LAST_BITS = 12, 12, 60
#: Up to so many keys of dropped rows are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 200_000


class PatriciaTrie:
    """A compressed radix trie over byte strings. A node is [label, children, payload]; children None marks a spilled subtree."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]
        self.held = self.ends = self.forks = 0

    def add(self, key: bytes, rank: tuple, rows: int, sha: bytes = b"") -> bool:
        """Insert a key, the rank of its best row and a number of rows; False if it belongs to a spilled subtree."""
        node, at = self.root, 0
        while at < len(key):
            child = node[1].get(key[at])
            if child is None:
                child = node[1][key[at]] = [key[at:], {}, None]
                self.held += len(key) - at + NODE_BYTES
                node = child
                break
            label = child[0]
            if key.startswith(label, at):
                if child[1] is None:
                    return False
                node, at = child, at + len(label)
                continue
            low, high = 1, min(len(label), len(key) - at)  # the first differing byte, by bisection over equal prefixes
            while low < high:
                half = (low + high + 1) // 2
                low, high = (half, high) if key.startswith(label[:half], at) else (low, half - 1)
            node[1][key[at]] = fork = [label[:low], {label[low]: child}, None]
            child[0] = label[low:]
            self.held += NODE_BYTES
            self.forks += 1
            node, at = fork, at + low
        best = node[2]
        self.ends += best is None
        node[2] = (rank, rows, sha) if best is None else (min(best[0], rank), best[1] + rows, sha)
        return True

    def below(self, above: bytes, node: list) -> Iterator[tuple[bytes, tuple, int, bytes]]:
        """(key, rank, rows, sha) of the terminals in the subtree of `node`, whose label follows the bytes `above`."""
        stack = [(above, node)]
        while stack:
            above, (label, children, payload) = stack.pop()
            key = above + label
            if payload:
                yield key, *payload
            if children:
                stack.extend((key, child) for child in children.values())

    def terminals(self) -> Iterator[tuple[bytes, tuple, int]]:
        """(key, rank, rows) of all keys."""
        return (found[:3] for found in self.below(b"", self.root))

    def _weight(self, node: list) -> tuple[int, int]:
        """Bytes and terminals of a subtree."""
        size = ends = 0
        stack = [node]
        while stack:
            label, children, payload = stack.pop()
            size += len(label) + NODE_BYTES
            ends += payload is not None
            stack.extend((children or {}).values())
        return size, ends

    def spilled(self, for_good: bool) -> list[tuple[bytes, tuple, int, bytes]]:
        """The terminals of a heavy subtree, half of the trie at most if it can be, which leaves the trie. for_good: its later keys are refused."""
        node, above = self.root, b""
        while True:
            first, (size, ends) = max(((b, self._weight(c)) for b, c in node[1].items() if c[1] is not None), key=lambda x: x[1])
            child = node[1][first]
            if 2 * size <= self.held or all(c[1] is None for c in child[1].values()):
                break
            node, above = child, above + child[0]
        out = list(self.below(above, child))
        self.held -= size
        self.ends -= ends
        if for_good:
            node[1][first] = [bytes([first]), None, None]
        else:
            del node[1][first]
        return out


_KEY = "nbytes long, sha binary, chars long, missing boolean, id long, row long, n long"
#: kind: 0 a document, 1 a text (with body on its way to a trie, without when it is done), 2 a spilled text.
_SCHEMA = f"kind int, length long, bits long, body binary, {_KEY}"
_COLUMNS = [x.split()[0] for x in _SCHEMA.split(", ")]


def _leading(sha: bytes, bits: int) -> int:
    return int.from_bytes(sha[:8], "big") >> (64 - bits) if bits else 0


def _texts(found, kind: int, bits: int | None) -> pd.DataFrame:
    """Rows of terminals; bits None: done, without their bodies."""
    rows = [
        (kind, len(key), 0 if bits is None else _leading(sha, bits), None if bits is None else key, len(key), sha, -rank[0], rank[1], rank[2], rank[3], n)
        for key, rank, n, sha in found
    ]
    return pd.DataFrame(rows, columns=_COLUMNS)


def _each(batch: pd.DataFrame) -> Iterator[tuple]:
    columns = (batch[c].tolist() for c in ("length", "bits", "body", "sha", "chars", "missing", "id", "row", "n"))
    for length, bits, body, sha, chars, missing, doc_id, row, n in zip(*columns, strict=True):
        yield (length, bits), bytes(body), (-chars, missing, doc_id, row), n, bytes(sha)


def _local(batches: Iterator[pd.DataFrame], budget: int, bits: int) -> Iterator[pd.DataFrame]:
    """A task's own rows: each as a narrow row, and their texts by a trie, in parts where it outgrows the budget."""
    trie = PatriciaTrie()
    for batch in batches:
        yield batch.assign(kind=0, length=-1, bits=batch["row"] % 4096, body=None)[_COLUMNS]
        for _, body, rank, n, sha in _each(batch):
            trie.add(body, rank, n, sha)
            while trie.held > budget and trie.ends > 1:
                yield _texts(trie.spilled(False), 1, bits)
    yield _texts(trie.below(b"", trie.root), 1, bits)


def _owned(batches: Iterator[pd.DataFrame], budget: int, more_bits: int | None) -> Iterator[pd.DataFrame]:
    """Rows ordered by (length, bits): documents as they are, owners of texts, and spilled texts. more_bits None: nothing may spill."""
    trie, last = PatriciaTrie(), None
    for batch in batches:
        passing = batch["kind"] == 0
        if passing.any():
            yield batch[passing]
        out = []
        for bucket, body, rank, n, sha in _each(batch[~passing]):
            if bucket != last and trie.held > budget // 2:
                yield _texts(trie.below(b"", trie.root), 1, None)
                trie = PatriciaTrie()
            last = bucket
            if not trie.add(body, rank, n, sha):
                out.append((body, rank, n, sha))
            while more_bits is not None and trie.held > budget and trie.ends > 1:
                yield _texts(trie.spilled(True), 2, more_bits)
        if out:
            yield _texts(out, 2, more_bits)
    yield _texts(trie.below(b"", trie.root), 1, None)


def _hashed(docs: DataFrame) -> DataFrame:
    """One row per document, with the bytes of its text without white space."""
    body = F.encode(stripped(F.col("text")), "UTF-8")
    rows = docs.select(
        body.alias("body"), F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"),
        F.col("doc_id").isNull().alias("missing"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.select("*", F.octet_length("body").cast("long").alias("nbytes"), F.unhex(F.sha2("body", 256)).alias("sha"), F.lit(1).cast("long").alias("n"), F.lit(0).cast("long").alias("length"), F.lit(0).cast("long").alias("bits"))


def _dealt(rows: DataFrame, budget: int, bits: int) -> DataFrame:
    more = bits + MORE_BITS if bits < LAST_BITS else None
    return rows.repartition("length", "bits").sortWithinPartitions("length", "bits").mapInPandas(lambda it: _owned(it, budget, more), _SCHEMA)


def members(docs: DataFrame, trie_bytes: int = TRIE_BYTES, first_bits: int = FIRST_BITS) -> DataFrame:
    """One row per document: missing, id, chars, row, sha, and keep (missing, id, chars, row of its owner), group_size."""
    small_batches(docs.sparkSession)
    local = _hashed(docs).mapInPandas(lambda it: _local(it, trie_bytes, first_bits), _SCHEMA)
    out = saved(_dealt(local, trie_bytes, first_bits))
    narrow, owners, bits = out.filter("kind = 0"), out.filter("kind = 1"), first_bits
    while not (spilled := out.filter("kind = 2")).isEmpty():
        bits = min(LAST_BITS, bits + MORE_BITS)
        out = saved(_dealt(spilled.withColumn("kind", F.lit(1)), trie_bytes, bits))
        owners = owners.unionByName(out.filter("kind = 1"))
    keep = owners.select("nbytes", "sha", F.struct("missing", "id", "chars", "row").alias("keep"), F.col("n").alias("group_size"))
    return join_many(narrow.select("nbytes", "sha", "missing", "id", "chars", "row"), keep, ["nbytes", "sha"], "group_size", narrow.count())


def _id(at: str) -> Column:
    return F.when(~F.col(f"{at}missing"), F.col(f"{at}id"))


def exact_duplicates(docs: DataFrame, trie_bytes: int = TRIE_BYTES, first_bits: int = FIRST_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return members(docs, trie_bytes, first_bits).select(
        _id("").alias("doc_id"), _id("keep.").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """`docs` without the rows that exact_duplicates would drop; the columns stay, whatever their names.

    Rows to drop are found by (doc_id, length, hash); these keys are broadcast if they are few, so that no text moves again. Rows that
    repeat an owner's own key are made one.
    """
    found = saved(members(docs).filter("row <> keep.row").select("missing", "id", "chars", "sha", (F.struct("missing", "id", "chars") == F.struct("keep.missing", "keep.id", "keep.chars")).alias("repeats")).distinct())
    text = F.col("text")
    key = {
        "missing": F.col("doc_id").isNull(), "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
        "chars": F.char_length(F.coalesce(text, F.lit(""))).cast("long"), "sha": F.unhex(F.sha2(F.encode(stripped(text), "UTF-8"), 256)),
    }
    few = found.count() <= BROADCAST_KEYS
    rows = docs.select(F.struct("*").alias("doc"), *[v.alias(k) for k, v in key.items()])
    side = lambda df: F.broadcast(df) if few else df
    marked = rows.join(side(found), list(key), "left")
    single = marked.filter("repeats IS NULL").select("doc.*")
    if found.filter("repeats").isEmpty():
        return single
    repeated = marked.filter("repeats").groupBy(*key).agg(F.min_by("doc", "doc.text").alias("doc"))
    return single.unionByName(repeated.select("doc.*"))
