"""MinHash near-duplicates with sequential Bayesian verification.

1. Every text becomes its set of distinct word shingles; texts with equal sets
   (size and 128-bit digest) are one class, represented by its smallest key.
2. MinHash bands of the representatives fall into buckets; a bucket links its
   members to its smallest one, and the components of these links are the
   candidate groups.  All candidate pairs lie inside a group; none is written.
3. Inside a group, signatures are compared batch by batch.  After each batch
   the posterior of the similarity (uniform prior, binomial matches) prunes a
   pair whose chance to reach the threshold is under ``miss``.  Survivors are
   verified on the full sets.  A task gives a spanning forest of its links.
4. A large group is cut into chunks.  First its members meet a few leaders;
   then only what is outside its largest component meets all its chunks.
5. Components of the verified links give each row its class.

A pair at the threshold shares no bucket with probability
(1 - t^rows)^bands: 6e-5 for 0.8 and the defaults.

Edge cases: a null or empty text has no shingles and links with nothing; fewer
words than ``k`` are one shingle as a whole; a row with a null key links with
nothing and is kept; rows that repeat a key are one document and are all
returned; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.llm._common import (as_long, keyed_text, mix64, save_table, shingle_hashes,
                                  text_slices, word_hashes)
from tsengine.llm.graph import components

BANDS, ROWS = 32, 6
BATCH = 32                 # hashes compared at a time
CHUNK_SHINGLES = 1_000_000
CHUNK_NODES = 2_000
LEADERS = 8
BROADCAST_ROWS = 500_000   # ids sent to every executor at most (16 bytes each)

_rng = np.random.Generator(np.random.PCG64(977))
_MUL = _rng.integers(0, 2**64, 1024, np.uint64, endpoint=False) | np.uint64(1)
_ADD = _rng.integers(0, 2**64, 1024, np.uint64, endpoint=False)


def signature(s: np.ndarray, hashes: int) -> np.ndarray:
    """The upper 32 bits of each hash function's smallest value over the set."""
    out = np.full(hashes, np.iinfo(np.uint64).max)
    step = max(1, 1_000_000 // hashes)
    for i in range(0, len(s), step):
        part = s[i:i + step][:, None] * _MUL[:hashes] + _ADD[:hashes]
        np.minimum(out, part.min(axis=0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    acc = np.arange(1, bands + 1, dtype=np.uint64)
    for c in sig[:bands * rows].reshape(bands, rows).T:
        acc = mix64(acc ^ c)
    return as_long(acc)


def _sets(batch: pa.RecordBatch, k: int):
    words, at = word_hashes(batch.column("text"))
    for i in range(batch.num_rows):
        yield np.unique(shingle_hashes(words[at[i]:at[i + 1]], k))


def _sketch(k: int, bands: int, rows: int):
    def run(batches):
        for b in text_slices(batches):
            n, digest, buckets = [], [], []
            for s in _sets(b, k):
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                buckets.append(band_keys(signature(s, bands * rows), bands, rows) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(buckets, pa.list_(pa.int64()))], names=["key", "n", "digest", "buckets"])
    return run


def _members(k: int, hashes: int):
    def run(batches):
        for b in text_slices(batches):
            found = list(_sets(b, k))
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("grp"), pa.array([len(s) for s in found], pa.int64()),
                 pa.array([signature(s, hashes).tobytes() for s in found], pa.binary()),
                 pa.array([s.tobytes() for s in found], pa.binary())],
                names=["node", "grp", "n", "sig", "items"])
    return run


def least_matches(hashes: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """(hashes compared, matches needed): with fewer matches, the posterior
    chance P(J >= threshold) = P(Binomial(n + 1, threshold) <= matches) is
    under ``miss``."""
    out = []
    for n in [*range(BATCH, hashes, BATCH), hashes]:
        m, chance = 0, 0.0
        while m <= n:
            chance += comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
            if chance >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def link(a: list[int], b: list[int], node, comp, sig, items, percent: int, steps) -> list[tuple[int, int]]:
    """Verified links between the rows ``a`` and ``b`` of one task that join
    different components (a spanning forest)."""
    size = np.array([len(s) for s in items])
    comp = comp.copy()
    codes: list[np.ndarray] | None = None
    out = []
    b = np.asarray(b)
    for i in a:
        near = b[(comp[b] != comp[i]) & (100 * np.minimum(size[b], size[i]) >= percent * np.maximum(size[b], size[i]))]
        done, matches = 0, np.zeros(len(near), np.int64)
        for n, least in steps:
            if not len(near):
                break
            matches = matches + (sig[near, done:n] == sig[i, done:n]).sum(axis=1)
            keep = matches >= least
            near, matches, done = near[keep], matches[keep], n
        if not len(near):
            continue
        if codes is None:
            _, flat = np.unique(np.concatenate(items), return_inverse=True)
            codes = np.split(flat, np.cumsum(size)[:-1])
            mark = np.zeros(int(flat.max()) + 1, bool)
        mark[codes[i]] = True
        both = np.array([int(mark[codes[j]].sum()) for j in near])
        mark[codes[i]] = False
        for j in near[100 * both >= percent * (size[i] + size[near] - both)]:
            if comp[i] != comp[j]:
                out.append((int(node[i]), int(node[j])))
                comp[comp == comp[j]] = comp[i]
    return out


def _link_tasks(percent: int, steps, hashes: int):
    """Rows sorted by task -> verified links.  side 0 meets side 1; where a
    task has one side only, its rows meet each other."""
    def run(batches):
        rows: list = []
        now = None

        def close():
            side = np.array([r[0] for r in rows])
            node, comp = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
            sig = np.frombuffer(b"".join(r[3] for r in rows), np.uint32).reshape(len(rows), hashes)
            items = [np.frombuffer(r[4], np.uint64) for r in rows]
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            found = link(a.tolist(), b if len(b) else a, node, comp, sig, items, percent, steps) if len(a) else []
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())],
                names=["a", "b"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("grp", "i", "j", "side", "node", "comp", "sig", "items")]
            for g, i, j, *row in zip(*cols):
                if (g, i, j) != now:
                    if len(rows) > 1:
                        yield close()
                    rows, now = [], (g, i, j)
                rows.append(row)
        if len(rows) > 1:
            yield close()
    return run


def _verify(tasks: DataFrame, percent: int, miss: float, hashes: int, parts: int) -> DataFrame:
    tasks = (tasks.select("grp", "i", "j", "side", "node", "comp", "sig", "items")
             .repartition(parts, "grp", "i", "j").sortWithinPartitions("grp", "i", "j"))
    return tasks.mapInArrow(_link_tasks(percent, least_matches(hashes, percent / 100, miss), hashes), "a long, b long")


def _chunks(n, count):
    return F.ceil(F.greatest(n / F.lit(CHUNK_SHINGLES), count / F.lit(CHUNK_NODES))).cast("int")


def _spread(chunks) -> F.Column:
    return F.pmod(F.xxhash64("node"), chunks).cast("int")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80,
                    miss: float = 1e-6, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row a document: ``key, n_shingles, component_id, kept``."""
    spark, hashes = docs.sparkSession, bands * rows
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = keyed_text(docs, key, text)
    sketch = save_table(source.mapInArrow(
        _sketch(k, bands, rows), "key long, n long, digest binary, buckets array<long>"), "sketch")
    live = sketch.where("key is not null and digest is not null")
    classes = live.groupBy("digest", "n").agg(F.min("key").alias("node"))

    first = classes.select("digest", F.col("node").alias("key"))
    members = save_table(
        live.join(first, ["digest", "key"]).dropDuplicates(["digest", "key"])
        .select(F.col("key").alias("node"), F.explode("buckets").alias("bucket")), "buckets")
    shared = (members.groupBy("bucket").agg(F.min("node").alias("b"), F.max("node").alias("most"))
              .where("most <> b").select("bucket", "b"))
    groups = components(members.join(shared, "bucket").select(F.col("node").alias("a"), "b").distinct())
    groups = groups.select("node", F.col("comp").alias("grp"))
    ids = groups.select(F.col("node").alias("key"), "grp")
    ids = F.broadcast(ids) if groups.count() <= BROADCAST_ROWS else ids.hint("merge")
    found = source.join(ids, "key").select("key", "text", "grp")
    found = save_table(found.mapInArrow(
        _members(k, hashes), "node long, grp long, n long, sig binary, items binary")
        .where("n > 0"), "members")

    sizes = save_table(found.groupBy("grp").agg(F.sum("n").alias("s"), F.count("*").alias("c"))
                       .select("grp", _chunks(F.col("s"), F.col("c")).alias("chunks")), "groups")
    large = sizes.where("chunks > 1")
    small = found.join(sizes.where("chunks = 1"), "grp").select(
        "*", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), F.col("node").alias("comp"))
    links = _verify(small, percent, miss, hashes, parts)
    if not large.isEmpty():
        links = links.union(_large_groups(found.join(large, "grp"), percent, miss, hashes, parts))
    comps = components(save_table(links, "links"))

    out = (sketch.join(classes.select("digest", "node"), "digest", "left")
           .join(comps, "node", "left")
           .select(F.col("key").alias(key), F.col("n").alias("n_shingles"),
                   F.when(F.col("key").isNotNull(), F.coalesce("comp", "node", "key")).alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def _large_groups(found: DataFrame, percent: int, miss: float, hashes: int, parts: int) -> DataFrame:
    """Links inside groups of several chunks."""
    best = found.groupBy("grp").agg(F.expr(f"slice(array_sort(collect_set(if(pmod(xxhash64(node), chunks) = 0, node, null))), 1, {LEADERS})").alias("lead"))
    lead = best.select("grp", F.explode("lead").alias("node"))
    base = found.withColumn("comp", F.col("node"))
    leaders = base.join(lead, ["grp", "node"])
    one = leaders.select("*", F.lit(0).alias("side"), F.lit(0).alias("j"),
                         F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("i"))
    rest = base.select("*", F.lit(1).alias("side"), F.lit(0).alias("j"), _spread(F.col("chunks")).alias("i"))
    early = save_table(_verify(one.unionByName(rest), percent, miss, hashes, parts), "links")

    comps = components(early)
    base = (found.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    main = (base.groupBy("grp", "comp").agg(F.count("*").alias("c"))
            .groupBy("grp").agg(F.max_by("comp", F.struct("c", "comp")).alias("main")))
    outside = base.join(main, "grp").where("comp <> main").drop("main")
    cuts = outside.groupBy("grp").agg(_chunks(F.sum("n"), F.count("*")).alias("out_chunks"))
    a = (outside.join(cuts, "grp")
         .select("*", F.lit(0).alias("side"), _spread(F.col("out_chunks")).alias("i"),
                 F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j")).drop("out_chunks"))
    b = (base.join(cuts, "grp")
         .select("*", F.lit(1).alias("side"), _spread(F.col("chunks")).alias("j"),
                 F.explode(F.sequence(F.lit(0), F.col("out_chunks") - 1)).alias("i")).drop("out_chunks"))
    return early.union(_verify(a.unionByName(b), percent, miss, hashes, parts))
