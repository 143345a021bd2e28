"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as
sorted hash arrays in the shared folder, memory-mapped by the scoring tasks.

Counting: tasks hash words, sum equal words of a slice, and Spark's grouped
sums make the vocabulary; each shard is sorted and written as one array file,
and a word's id is its place in the sorted hashes.  Bigrams are counted in the
same way on pairs of ids.  A frequent context is spread over several shards by
its following word, so no shard holds a whole hot context.  The context
statistics and continuation counts are grouped sums over the counted bigrams
and become dense arrays by word id.  Only totals come to the driver.

Keys are 64-bit hashes; words or bigrams whose hashes collide share a count.

Edge cases: a null or empty text is the end token alone; a null key is scored
like any other; an empty training set gives the uniform model over the unknown
word; extra columns are ignored; repeated rows count as often as they occur.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsengine.llm._common import (_MIXERS, as_long, keyed_text, mix64, run_dir, save_table,
                                  text_slices, word_hashes)

END_HASH = np.uint64(0x5E7D0FEE5E7D0FEE)
SLICE = 2 << 20
FLUSH = 3_000_000        # tokens whose pairs a task holds at a time
RANGE_BITS = 16          # ids per file of the dense arrays: 2**16
BIG = 255                # counts from here on stand in the overflow arrays


class Store:
    """Array files below one URI.  On a shared file system tasks map them in
    place; on any other store a task maps a copy it fetches for itself."""

    def __init__(self, uri: str):
        self.uri = uri
        self.fs, self.path = pafs.FileSystem.from_uri(uri)
        self.local = isinstance(self.fs, pafs.LocalFileSystem)
        self._maps: dict = {}

    def __reduce__(self):
        return Store, (self.uri,)

    def write(self, name: str, chunks: list[np.ndarray]) -> None:
        """Write under a temporary name, then rename: a retried task replaces
        the file by the same content."""
        self.fs.create_dir(self.path, recursive=True)
        tmp = f"{self.path}/.{name}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(tmp) as out:
            for c in chunks:
                out.write(np.ascontiguousarray(c).tobytes())
        self.fs.move(tmp, f"{self.path}/{name}")

    def array(self, name: str, dtype) -> np.ndarray:
        if name not in self._maps:
            file = f"{self.path}/{name}"
            info = self.fs.get_file_info(file)
            if info.type == pafs.FileType.NotFound or not info.size:
                self._maps[name] = np.empty(0, dtype)
            elif self.local:
                self._maps[name] = np.memmap(file, dtype, "r")
            else:
                with tempfile.TemporaryFile() as copy, self.fs.open_input_stream(file) as src:
                    while block := src.read(1 << 22):
                        copy.write(block)
                    copy.flush()
                    self._maps[name] = np.memmap(copy, dtype, "r")
        return self._maps[name]


@dataclass
class Model:
    store: Store
    bits: int                       # log2 of the number of shards
    total: int = 0                  # N
    size: int = 0                   # V
    base: list[int] = field(default_factory=list)   # first id of each vocabulary shard
    low: tuple = (0.5, 0.5, 0.5)    # discounts of the continuation counts
    high: tuple = (0.5, 0.5, 0.5)   # discounts of the bigram counts
    cont_total: int = 0
    cont_classes: tuple = (0, 0, 0)

    # ---- vocabulary
    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, count) of word hashes; (-1, 0) for unknown words."""
        u, back = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(u), -1, np.int64), np.zeros(len(u), np.int64)
        for s, lo, hi in _runs(u >> np.uint64(64 - self.bits)):
            keys = self.store.array(f"vocab-{s}.key", np.uint64)
            if not len(keys):
                continue
            p = np.minimum(np.searchsorted(keys, u[lo:hi]), len(keys) - 1)
            hit = keys[p] == u[lo:hi]
            ids[lo:hi][hit] = self.base[s] + p[hit]
            counts[lo:hi][hit] = self.store.array(f"vocab-{s}.count", np.int64)[p[hit]]
        return ids[back], counts[back]

    # ---- bigrams
    def shard(self, ctx: np.ndarray, word: np.ndarray, ctx_count: np.ndarray) -> np.ndarray:
        shards = 1 << self.bits
        split = (1 + ctx_count * (2 * shards) // max(self.total, 1)).astype(np.uint64)
        salt = mix64(word.view(np.uint64) + _MIXERS[3]) % split
        h = mix64(ctx.view(np.uint64) * _MIXERS[1] + salt * _MIXERS[2])
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def bigram_counts(self, ctx, word, ctx_count) -> np.ndarray:
        key, first, back = np.unique(bigram_key(ctx, word), return_index=True, return_inverse=True)
        shard = self.shard(ctx[first], word[first], ctx_count[first])
        order = np.argsort(shard, kind="stable")
        out = np.zeros(len(key), np.int64)
        for s, lo, hi in _runs(shard[order]):
            at = order[lo:hi]
            keys = self.store.array(f"pair-{s}.key", np.uint64)
            if not len(keys):
                continue
            p = np.minimum(np.searchsorted(keys, key[at]), len(keys) - 1)
            c = np.where(keys[p] == key[at], self.store.array(f"pair-{s}.count", np.uint8)[p], 0).astype(np.int64)
            big = np.flatnonzero(c == BIG)
            if len(big):
                where = np.searchsorted(self.store.array(f"pair-{s}.bigkey", np.uint64), key[at][big])
                c[big] = self.store.array(f"pair-{s}.bigcount", np.int64)[where]
            out[at] = c
        return out[back]

    # ---- dense arrays by id
    def dense(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values of ids (0 for -1)."""
        out = np.zeros(len(ids))
        order = np.argsort(ids, kind="stable")
        for r, lo, hi in _runs(ids[order] >> RANGE_BITS):
            if r >= 0:
                at = order[lo:hi]
                values = self.store.array(f"word-{r}.{name}", np.float64)
                if len(values):         # there are none without training rows
                    out[at] = values[ids[at] & ((1 << RANGE_BITS) - 1)]
        return out

    def unigram(self, cont: np.ndarray) -> np.ndarray:
        """Interpolated continuation probability from continuation counts."""
        if not self.cont_total:
            return np.full(len(cont), 1.0 / (self.size + 1))
        spare = sum(d * n for d, n in zip(self.low, self.cont_classes)) / self.cont_total
        kept = np.maximum(cont - _discount(cont, self.low), 0) / self.cont_total
        return kept + spare / (self.size + 1)


def bigram_key(ctx: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(ctx.view(np.uint64) * _MIXERS[4] + word.view(np.uint64) * _MIXERS[5])


def _discount(c: np.ndarray, d: tuple) -> np.ndarray:
    return np.where(c <= 0, 0, np.where(c == 1, d[0], np.where(c == 2, d[1], d[2])))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple:
    """D1, D2, D3+ from counts of counts, D_k = k - (k+1) Y n_{k+1} / n_k with
    Y = n1 / (n1 + 2 n2), held in [0.05, k]; k / 2 where n_k is 0."""
    n, y = (n1, n2, n3, n4), n1 / (n1 + 2 * n2) if n1 else 0.0
    return tuple(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), float(k)) if n[k - 1] else k / 2
                 for k in (1, 2, 3))


def _runs(sorted_ids: np.ndarray):
    """(value, start, end) of each run in a sorted array."""
    if len(sorted_ids):
        cut = np.flatnonzero(np.diff(sorted_ids)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(sorted_ids)]):
            yield int(sorted_ids[lo]), lo, hi


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all tokens with one end per text, offsets by text, previous
    token's hash, 0 at a text's start)."""
    words, at = word_hashes(texts)
    out = np.insert(words, at[1:], END_HASH)
    offsets = at + np.arange(len(at))
    before = np.concatenate([np.zeros(1, np.uint64), out[:-1]])
    before[offsets[:-1]] = 0
    return out, offsets, before


def _summed(parts: list, keys: int) -> list[np.ndarray]:
    """Sum equal keys of buffered column lists: the first ``keys`` columns are the key."""
    cols = [np.concatenate(x) for x in zip(*parts)]
    order = np.lexsort(cols[:keys][::-1]) if keys > 1 else np.argsort(cols[0], kind="stable")
    cols = [c[order] for c in cols]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in cols[:keys]], axis=0)
    first = np.flatnonzero(new)
    return [c[first] for c in cols[:keys]] + [np.add.reduceat(c, first) if len(first) else c for c in cols[keys:]]


def _batch(names, cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=list(names))


def _emit(names, cols, rows: int = 100_000):
    for i in range(0, len(cols[0]), rows):
        yield _batch(names, [c[i:i + rows] for c in cols])


def _word_counts(batches):
    parts, held = [], 0
    for b in text_slices(batches, max_bytes=SLICE):
        t, _, _ = tokens(b.column("text"))
        u, c = np.unique(t, return_counts=True)
        parts.append((u, c.astype(np.int64)))
        held += len(u)
        if held > FLUSH // 2:
            k, n = _summed(parts, 1)
            yield from _emit(("w", "c"), (as_long(k), n))
            parts, held = [], 0
    if parts:
        k, n = _summed(parts, 1)
        yield from _emit(("w", "c"), (as_long(k), n))


def _pair_counts(model: Model):
    def run(batches):
        parts, held = [], 0

        def flush():
            ctx, word = parts_arrays(parts)
            parts.clear()
            key = bigram_key(ctx, word)
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.concatenate([np.ones(1, bool), key[1:] != key[:-1]]))
            n = np.diff(np.append(first, len(key)))
            del key
            ctx, word = ctx[order[first]], word[order[first]]
            del order
            for i in range(0, len(n), 500_000):
                c, w, k = ctx[i:i + 500_000], word[i:i + 500_000], n[i:i + 500_000]
                shard = model.shard(c, w, context_counts(model, c)[1]).astype(np.int32)
                yield from _emit(("shard", "ctx", "word", "c"), (shard, c, w, k))

        for b in text_slices(batches, max_bytes=SLICE):
            t, offsets, _ = tokens(b.column("text"))
            ids, _ = model.lookup(t)
            ctx = np.concatenate([np.full(1, model.size), ids[:-1]])
            ctx[offsets[:-1]] = model.size
            parts.append((ctx, ids))
            held += len(ids)
            if held > FLUSH:
                yield from flush()
                held = 0
        if parts:
            yield from flush()
    return run


def parts_arrays(parts: list) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts)]


def context_counts(model: Model, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each context id occurs as a token (the text start: as often as the end)."""
    starts = np.array([*model.base, model.size], np.int64)
    u, back = np.unique(ctx, return_inverse=True)
    out = np.zeros(len(u), np.int64)
    shard = np.searchsorted(starts[1:], u, "right")
    for s, lo, hi in _runs(shard):
        if s < len(model.base):
            out[lo:hi] = model.store.array(f"vocab-{s}.count", np.int64)[u[lo:hi] - starts[s]]
        else:
            out[lo:hi] = model.lookup(np.array([END_HASH]))[1][0]
    return u, out[back]


def _write_vocab(store: Store):
    def run(batches):
        keys, counts, now = [], [], None

        def close():
            k = np.concatenate(keys)
            c = np.concatenate(counts)
            store.write(f"vocab-{now}.key", [k])
            store.write(f"vocab-{now}.count", [c])
            return _batch(("shard", "n", "total"), ([now], [len(k)], [int(c.sum())]))

        for b in batches:
            s, k, c = (b.column(x).to_numpy() for x in ("shard", "k", "c"))
            for v, lo, hi in _runs(s):
                if v != now and now is not None:
                    yield close()
                    keys, counts = [], []
                now = v
                keys.append(k[lo:hi].view(np.uint64))
                counts.append(c[lo:hi])
        if now is not None:
            yield close()
    return run


def _write_pairs(store: Store):
    """Sorted pairs of whole shards -> array files; gives partial statistics by
    word id: as a context (sum of counts, followers seen once, twice, more
    often), as a word (distinct predecessors), and counts of counts (id -1)."""
    names = ("id", "c", "n1", "n2", "n3", "n4", "cont")

    def run(batches):
        held: list = []
        rows, now = 0, None
        files: dict[str, list] = {}

        def stats():
            ctx, word, c = parts_arrays(held)
            held.clear()
            u, back = np.unique(ctx, return_inverse=True)
            zero = np.zeros(len(u), np.int64)
            cls = [np.bincount(back[x], minlength=len(u)) for x in (c == 1, c == 2, c >= 3)]
            yield from _emit(names, (u, np.bincount(back, c, len(u)).astype(np.int64), *cls, zero, zero))
            u, n = np.unique(word, return_counts=True)
            zero = np.zeros(len(u), np.int64)
            yield from _emit(names, (u, zero, zero, zero, zero, zero, n))
            yield _batch(names, [np.array([x]) for x in (-1, 0, *[int((c == i).sum()) for i in (1, 2, 3, 4)], 0)])

        def close():
            key = np.concatenate(files["key"])
            c = np.concatenate(files["count"])
            order = np.argsort(key)
            key, c = key[order], c[order]
            big = c >= BIG
            store.write(f"pair-{now}.key", [key])
            store.write(f"pair-{now}.count", [np.minimum(c, BIG).astype(np.uint8)])
            if big.any():
                store.write(f"pair-{now}.bigkey", [key[big]])
                store.write(f"pair-{now}.bigcount", [c[big]])

        for b in batches:
            s, ctx, word, c = (b.column(x).to_numpy() for x in ("shard", "ctx", "word", "c"))
            for v, lo, hi in _runs(s):
                if v != now:
                    if now is not None:
                        close()
                    files, now = {"key": [], "count": []}, v
                files["key"].append(bigram_key(ctx[lo:hi], word[lo:hi]))
                files["count"].append(c[lo:hi])
            held.append((ctx, word, c))
            rows += len(c)
            if rows > FLUSH // 3:
                yield from stats()
                rows = 0
        if now is not None:
            close()
        if held:
            yield from stats()
    return run


def _write_words(model: Model):
    """Sorted word statistics -> dense arrays by id, one file a range of ids."""
    width = 1 << RANGE_BITS

    def run(batches):
        held: list = []
        now = None

        def close():
            ids, c, gamma, p = parts_arrays(held)
            for name, x in (("count", c), ("gamma", gamma), ("p", p)):
                dense = np.zeros(width)
                dense[ids & (width - 1)] = x
                model.store.write(f"word-{now}.{name}", [dense[:int(ids.max() & (width - 1)) + 1]])
            return _batch(("r",), ([now],))

        for b in batches:
            r, ids, c, n1, n2, n3, cont = (b.column(x).to_numpy() for x in ("r", "id", "c", "n1", "n2", "n3", "cont"))
            gamma = (model.high[0] * n1 + model.high[1] * n2 + model.high[2] * n3) / np.maximum(c, 1)
            p = model.unigram(cont)
            for v, lo, hi in _runs(r):
                if v != now and now is not None:
                    yield close()
                    held = []
                now = v
                held.append((ids[lo:hi], c[lo:hi].astype(float), gamma[lo:hi], p[lo:hi]))
        if now is not None:
            yield close()
    return run


def fit(docs: DataFrame, text: str = "text", learn: Column | None = None) -> Model:
    """Count a bigram model over ``docs`` (rows where ``learn`` holds).  Runs
    Spark jobs; the arrays stay in the shared folder until it is cleaned."""
    spark = docs.sparkSession
    rows = docs if learn is None else docs.where(learn)
    rows = rows.select(F.coalesce(rows[text].cast("string"), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(4, int(np.ceil(np.log2(parts))))
    model = Model(Store(run_dir(spark, "kneser-ney")), bits)

    words = rows.mapInArrow(_word_counts, "w long, c long")
    vocab = (words.withColumn("shard", F.shiftrightunsigned("w", 64 - bits).cast("int"))
             .repartition(parts, "shard").groupBy("shard", "w").agg(F.sum("c").alias("c"))
             .select("shard", F.col("w").alias("k"), "c")
             .sortWithinPartitions("shard", "k"))
    # inside a shard the leading bits are equal, so signed order is unsigned order
    sizes = {r.shard: r for r in vocab.mapInArrow(_write_vocab(model.store), "shard long, n long, total long").collect()}
    n = [sizes[s].n if s in sizes else 0 for s in range(1 << bits)]
    model.base = [0, *np.cumsum(n).tolist()[:-1]]
    model.size, model.total = sum(n), sum(r.total for r in sizes.values())

    pairs = (rows.mapInArrow(_pair_counts(model), "shard int, ctx long, word long, c long")
             .repartition(parts, "shard").groupBy("shard", "ctx", "word").agg(F.sum("c").alias("c"))
             .sortWithinPartitions("shard"))
    cols = ("c", "n1", "n2", "n3", "n4", "cont")
    stats = save_table(
        pairs.mapInArrow(_write_pairs(model.store), "id long, " + ", ".join(f"{c} long" for c in cols))
        .groupBy("id").agg(*[F.sum(c).alias(c) for c in cols]), "kneser-ney-words")
    whole = stats.agg(*[F.sum(F.when(F.col("id") == -1, F.col(f"n{i}"))).alias(f"b{i}") for i in (1, 2, 3, 4)],
                      F.sum("cont").alias("t"),
                      *[F.sum(F.when(F.col("cont") == i, 1)).alias(f"c{i}") for i in (1, 2, 3, 4)],
                      F.sum(F.when(F.col("cont") >= 3, 1)).alias("c3p")).first()
    model.high = discounts(*[whole[f"b{i}"] or 0 for i in (1, 2, 3, 4)])
    model.low = discounts(*[whole[f"c{i}"] or 0 for i in (1, 2, 3, 4)])
    model.cont_total = whole["t"] or 0
    model.cont_classes = (whole["c1"] or 0, whole["c2"] or 0, whole["c3p"] or 0)

    dense = (stats.where("id >= 0").withColumn("r", F.shiftright("id", RANGE_BITS))
             .repartition(parts, "r").sortWithinPartitions("r"))
    dense.mapInArrow(_write_words(model), "r long").agg(F.count("*")).collect()
    return model


SCORE_SCHEMA = ("key long, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")


def _score(model: Model):
    def run(batches):
        empty = 0.5 / (model.total + 0.5 * (model.size + 1))
        for b in text_slices(batches, max_bytes=SLICE):
            t, offsets, _ = tokens(b.column("text"))
            ids, count = model.lookup(t)
            ctx = np.concatenate([np.full(1, model.size), ids[:-1]])
            ctx[offsets[:-1]] = model.size
            row = np.repeat(np.arange(b.num_rows), np.diff(offsets))
            cont_p = model.dense("p", ids)
            p = np.where(ids >= 0, cont_p, model.unigram(np.zeros(1))[0])
            ctx_c, gamma = model.dense("count", ctx), model.dense("gamma", ctx)
            both = np.flatnonzero((ids >= 0) & (ctx_c > 0))
            ctx_n = np.where(ctx == model.size, 0, np.concatenate([np.zeros(1, np.int64), count[:-1]]))
            start = ctx == model.size
            if start.any():
                ctx_n[start] = model.lookup(np.array([END_HASH]))[1][0]
            pair = np.zeros(len(ids), np.int64)
            pair[both] = model.bigram_counts(ctx[both], ids[both], ctx_n[both])
            seen = ctx_c > 0
            kept = np.maximum(pair - _discount(pair, model.high), 0) / np.maximum(ctx_c, 1)
            p = np.where(seen, kept + gamma * p, p)
            base = np.log10((count + 0.5) * (empty / 0.5))
            size = b.num_rows
            yield pa.RecordBatch.from_arrays([
                b.column("key"), pa.array(np.diff(offsets)),
                pa.array(np.bincount(row, count > 0, size).astype(np.int64)),
                pa.array(np.full(size, model.total, np.int64)),
                pa.array(np.bincount(row, base, size)),
                pa.array(np.bincount(row, np.log10(p), size))],
                names=["key", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: tokens, known tokens, unigram base score and the
    model's log10 probability of the whole text."""
    return keyed_text(docs, key, text).mapInArrow(_score(model), SCORE_SCHEMA)


def perplexity(scored: DataFrame) -> DataFrame:
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
