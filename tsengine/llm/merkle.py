"""Merkle manifest of a dataset: an append log of tree nodes in postorder.

A tree has fan-out 8.  Its leaves stand in order of their key; while several
nodes remain, every 8 consecutive ones (the last run: fewer, even one) become
their hash.  An append log writes a leaf when it arrives and a node as soon as
its last child is written, so the log is the tree's postorder, and where a node
stands follows from sizes alone: node ``j`` of ``level`` ends with leaf
``e = min((j + 1) * 8**level, n) - 1``; before that leaf stand ``e`` leaves and
``e // 8**k`` nodes of every level ``k`` (complete subtrees), and ``level``
nodes complete after it (``position``).

Spark numbers the leaves of all trees in one range sort (``number_rows``).
Builders are aligned: one holds the 512 consecutive leaves of a subtree of three
levels (``SPAN``), writes its nodes in completion order, and hands its top on;
the tops are leaves of the next round.  So no task holds more than 512 digests,
whatever share of the rows one tree has, and a segment of the log is one row.
The tops of the trees are leaves of one more tree, in order of the tree's name.

Proofs are read top down: a segment addresses the siblings of each of its
members by their positions and adds what its own top's proof holds.

Edge cases.  Null tree names form a tree of their own, before all others; null
keys come first; rows that repeat a key are leaves of their own, in order of
their digests; equal rows are equal leaves side by side.  Null fields count as
``-``.  An empty table has no leaves and no root (null).  Other columns take no
part.  Digests are lower-case hexadecimal SHA-256.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsengine.llm._common import bound_batches, save_table

FANOUT = 8
SPAN = 3  # levels of one builder
BLOCK = FANOUT ** SPAN
HEX = 64

_PATH = "array<struct<before string, after string>>"


# ------------------------------------------------------------- positions

def depth(n: int) -> int:
    """Levels above ``n`` leaves (0 for a lone leaf)."""
    d = 0
    while n > 1:
        n, d = -(-n // FANOUT), d + 1
    return d


def position(level: int, j: int, n: int) -> int:
    """Place in the log of node ``j`` of ``level`` in a tree of ``n`` leaves."""
    end = min((j + 1) * FANOUT ** level, n) - 1
    at, k = end + level, end
    while k:
        k //= FANOUT
        at += k
    return at


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def append_all(leaves: Sequence[str], levels: int) -> list[str]:
    """The log of ``leaves`` and all nodes of ``levels`` levels, in completion order."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(levels + 1)]
    for node in leaves:
        log.append(node)
        for level in range(levels):
            waiting[level].append(node)
            if len(waiting[level]) < FANOUT:
                break
            node = _digest("".join(waiting[level]))
            waiting[level].clear()
            log.append(node)
    for level in range(levels):  # runs that no further leaf will fill
        if waiting[level]:
            node = _digest("".join(waiting[level]))
            waiting[level + 1].append(node)
            log.append(node)
    return log


def sibling_path(log: str, n: int, levels: int) -> list[list[tuple[str, str]]]:
    """By level and node: the digests before and after it in its run, addressed
    by position in ``log`` (all digests of a segment of ``n`` leaves as one text)."""
    out, count = [], n
    for level in range(levels):
        at = [HEX * position(level, j, n) for j in range(count)]
        texts = [log[i:i + HEX] for i in at]
        rows = []
        for j in range(count):
            first = j - j % FANOUT
            rows.append(("".join(texts[first:j]), "".join(texts[j + 1:first + FANOUT])))
        out.append(rows)
        count = -(-count // FANOUT)
    return out


# ------------------------------------------------------------- Spark side

def framed(*fields: Column) -> Column:
    """``-`` for null, else the UTF-8 length, ``:`` and the value, one after another."""
    def one(c):
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.concat(*[one(c) for c in fields])


def leaf_digest(*fields: Column) -> Column:
    return F.sha2(framed(*fields), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def tree_key(name: Column) -> Column:
    """Text that sorts null first, then bytewise by name."""
    return F.coalesce(F.concat(F.lit("+"), name.cast("string")), F.lit(""))


def number_rows(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``i``, the place of a row in its ``tree`` by ``order`` (from 0), and
    ``n``, the tree's rows.  One range sort over all trees; places follow from
    the counts of the sorted parts, so a large tree is no single task."""
    keys = ["tree", *order]
    sorted_rows = (rows.withColumn("tie", F.rand(11)).repartitionByRange(*keys, "tie")
                   .sortWithinPartitions(*keys, "tie").drop("tie")
                   .withColumn("part", F.spark_partition_id())
                   .withColumn("at", F.monotonically_increasing_id()))
    sorted_rows = save_table(sorted_rows, "merkle-leaves")
    parts = sorted_rows.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("tree", "part", "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
                           F.sum("rows").over(Window.partitionBy("tree")).alias("n"))
    return (sorted_rows.join(offsets, ["tree", "part"])
            .withColumn("i", F.col("before") + F.col("at") - F.col("first"))
            .drop("part", "at", "first", "before"))


def _segments(numbered: DataFrame) -> DataFrame:
    """One row a block of 512 leaves: its members in order, its log, its top."""
    members = numbered.groupBy("tree", F.shiftright("i", 3 * SPAN).alias("block")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "digest", "payload"))).alias("members"))
    schema = T.StructType([*members.schema.fields, T.StructField("log", T.StringType()), T.StructField("top", T.StringType())])
    return save_table(members.mapInArrow(_write_logs, schema), "merkle-log")


def _write_logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column("n").to_pylist()
        members = batch.column("members")
        digests = pa.ListArray.from_arrays(_starts(members), members.flatten().field("digest"))
        logs = [append_all(leaves.as_py(), min(SPAN, depth(n))) for leaves, n in zip(digests, sizes)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(["".join(x) for x in logs], pa.string()),
             pa.array([x[-1] for x in logs], pa.string())], names=[*batch.schema.names, "log", "top"])


def _starts(lists: pa.ListArray) -> pa.Array:
    """Offsets into ``lists.flatten()`` (which leaves out what a slice skips)."""
    at = [0]
    for n in lists.value_lengths().to_pylist():
        at.append(at[-1] + n)
    return pa.array(at, pa.int32())


def _read_proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path_type = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    for batch in batches:
        for r in range(batch.num_rows):
            row = {c: batch.column(c)[r] for c in ("tree", "n", "log", "subroot")}
            members = batch.column("members").slice(r, 1).flatten()
            count = len(members)
            levels = min(SPAN, depth(row["n"].as_py()))
            steps = sibling_path(row["log"].as_py(), count, levels)
            above = [(s["before"], s["after"]) for s in batch.column("above")[r].as_py()]
            before, after, at = [], [], [0]
            for i in range(count):
                path = [steps[level][i // FANOUT ** level] for level in range(levels)] + above
                before += [x for x, _ in path]
                after += [x for _, x in path]
                at.append(len(before))
            steps_of = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())],
                                                  ["before", "after"])
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(row["tree"], count), members.field("i"), members.field("digest"), members.field("payload"),
                 pa.repeat(row["subroot"], count), pa.ListArray.from_arrays(pa.array(at, pa.int32()), steps_of, type=path_type)],
                names=["tree", "i", "digest", "payload", "subroot", "path"])


@dataclasses.dataclass
class Manifest:
    """Segments of the log by round (leaves first), those of the tree of trees, its root."""

    rounds: list[DataFrame]
    top_rounds: list[DataFrame]
    root: str | None


def _grow(numbered: DataFrame) -> list[DataFrame]:
    rounds = [_segments(numbered)]
    while not (larger := rounds[-1].where(F.col("n") > BLOCK)).isEmpty():
        rounds.append(_segments(larger.select(
            "tree", F.col("block").alias("i"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"),
            F.col("top").alias("digest"), F.lit(None).cast("string").alias("payload"))))
    return rounds


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """The top of every tree, from the round that holds it whole."""
    out = [x.where(F.col("n") <= BLOCK).select("tree", "top") for x in rounds]
    tops = out[0]
    for x in out[1:]:
        tops = tops.unionByName(x)
    return tops


def build(rows: DataFrame, tree: str, key: str, leaf: Column, **carry: Column) -> Manifest:
    """The manifest of ``rows``: a tree for each value of ``tree``, its leaves
    ``leaf`` in order of ``key``, and the tree of trees.  ``carry`` names what a
    leaf's proof shall bring along besides the key."""
    bound_batches(rows.sparkSession)
    leaves = rows.select(tree_key(rows[tree]).alias("tree"), rows[key].alias("key"), leaf.alias("digest"),
                         F.struct(rows[key].alias("key"), *[c.alias(n) for n, c in carry.items()]).alias("payload"))
    rounds = _grow(number_rows(leaves, ["key", "digest"]).drop("key"))
    tops = _tops(rounds).select(F.lit("").alias("tree"), F.col("tree").alias("payload"), F.col("top").alias("digest"))
    top_rounds = _grow(number_rows(tops, ["payload"]))
    root = _tops(top_rounds).first()
    return Manifest(rounds, top_rounds, root["top"] if root else None)


def _prove(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Proofs of the first round's members; ``above`` has each tree's own."""
    proofs = None
    for segments in reversed(rounds):
        whole = (segments.where(F.col("n") <= BLOCK).select("tree", "block")
                 .join(above.withColumnRenamed("path", "above"), "tree"))
        if proofs is not None:
            whole = whole.unionByName(proofs.select("tree", F.col("i").alias("block"), "subroot",
                                                    F.col("path").alias("above")))
        payload = segments.schema["members"].dataType.elementType["payload"].dataType.simpleString()
        proofs = segments.join(whole, ["tree", "block"]).mapInArrow(
            _read_proofs, f"tree string, i long, digest string, payload {payload}, subroot string, path {_PATH}")
    return proofs


def proofs(manifest: Manifest) -> DataFrame:
    """One row a leaf: ``tree``, ``i`` (place in it), ``digest``, ``payload`` (the
    key and what was carried), ``subroot`` (its tree's top) and ``path`` (by
    level up to the root: the siblings before and after)."""
    none = F.array().cast(_PATH)
    top = _tops(manifest.top_rounds).select("tree", none.alias("path"), F.lit("").alias("subroot"))
    trees = _prove(manifest.top_rounds, top)
    above = save_table(trees.select(F.col("payload").alias("tree"), F.col("digest").alias("subroot"), "path"),
                       "merkle-trees")
    return _prove(manifest.rounds, above)


def position_of(level: int, j: Column, n: Column) -> Column:
    """``position`` as an expression, for one level."""
    end = F.least((j + 1) * FANOUT ** level, n) - 1
    at = end + level
    for k in range(1, 21):  # 8**21 exceeds every row count
        at = at + F.shiftright(end, 3 * k)
    return at


def log_entries(manifest: Manifest) -> DataFrame:
    """The whole append log: ``tree``, ``position``, ``level``, ``digest``."""
    sizes = manifest.rounds[0].groupBy("tree").agg(F.max("n").alias("leaves"))
    out = None
    for r, segments in enumerate(manifest.rounds):
        held = F.least(F.lit(BLOCK), F.col("n") - F.col("block") * BLOCK)
        for up in range(min(r, 1), SPAN + 1):  # a later round's leaves are in the log already
            count = F.ceil(held / FANOUT ** up).cast("long")
            nodes = (segments.where(F.col("n") > (FANOUT ** (up - 1) if up else 0))
                     .select("tree", "block", "log", held.alias("held"), F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("node"))
                     .join(sizes, "tree"))
            at = position_of(up, F.col("node"), F.col("held"))
            level, j = SPAN * r + up, F.col("block") * FANOUT ** (SPAN - up) + F.col("node")
            nodes = nodes.select("tree", position_of(level, j, F.col("leaves")).alias("position"), F.lit(level).alias("level"),
                                 F.col("log").substr((at * HEX + 1).cast("int"), F.lit(HEX)).alias("digest"))
            out = nodes if out is None else out.unionByName(nodes)
    return out
