"""Benchmark decontamination by SimHash over item-sized windows.

For every benchmark item of ``m`` words, a document's windows of ``m`` words
(a document of fewer words as a whole) get a 64-bit SimHash of their word shingles (running sums of the bits, so a
window costs the same for every size).  Four 16-bit blocks index the items'
fingerprints: a fingerprint within ``radius`` differs in at most ``radius // 4``
bits in some block, and the index holds every such neighbour of every block,
so all items within the radius are found.  Candidates are verified by the
exact weighted similarity of the shingles (weight: how often a shingle occurs;
sum of minima over sum of maxima).

Only windows that hold at least one shingle of some item are fingerprinted:
any other has a similarity of 0 with every item.

The benchmark is taken in blocks of ``BLOCK_ITEMS`` items and
``BLOCK_WORDS`` words, one pass over the documents for each, so what a task
holds is bounded whatever the benchmark's size.

Edge cases: null or empty texts and items never match; an item of fewer words
than ``k`` is one shingle as a whole; repeated items (same id and text) count
once; documents with a null key are scanned and keep the null key; repeated
rows each give their matches; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.llm._common import keyed_text, shingle_hashes, text_slices, word_hashes

RADIUS = 19
BLOCK_ITEMS, BLOCK_WORDS = 2_000, 1_000_000
SCHEMA = "key long, item_id long, start_word long, end_word long, distance long, similarity double"
_SHIFTS = np.arange(64, dtype=np.uint64)


def simhash(sums: np.ndarray) -> np.ndarray:
    """Fingerprints from the sums of the shingles' bits as +1 and -1."""
    return np.packbits(sums > 0, axis=-1, bitorder="little").view(np.uint64)[..., 0]


def bit_sums(shingles: np.ndarray) -> np.ndarray:
    """Running sums (one row more than shingles) of the bits as +1 and -1."""
    bits = np.unpackbits(shingles[:, None].view(np.uint8), axis=1, bitorder="little")
    out = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits.astype(np.int8) * 2 - 1, axis=0, dtype=np.int32, out=out[1:])
    return out


def similarity(a: Counter, b: Counter) -> float:
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


class Items:
    """One block of benchmark items, with its index."""

    def __init__(self, rows: list[tuple[int, str]], k: int, radius: int, least: float):
        words, at = word_hashes(pa.array([t for _, t in rows], pa.string()))
        self.ids, self.words, self.shingles = [], [], []
        for i, (item, _) in enumerate(rows):
            w = words[at[i]:at[i + 1]]
            if len(w):
                self.ids.append(item)
                self.words.append(len(w))
                self.shingles.append(shingle_hashes(w, k))
        self.k, self.radius, self.least = k, radius, least
        self.size = np.array(self.words, np.int64)
        self.bags = [Counter(s.tolist()) for s in self.shingles]
        self.prints = np.array([simhash(bit_sums(s)[-1]) for s in self.shingles], np.uint64)
        flat = np.concatenate([*self.shingles, np.empty(0, np.uint64)])
        owner = np.repeat(np.arange(len(self.ids)), [len(s) for s in self.shingles])
        order = np.argsort(flat, kind="stable")
        self.known, self.owner = flat[order], owner[order]
        self.short = sorted({int(n) for n in self.size if n < k})
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[flat >> np.uint64(44)] = True
        self._index()

    def _index(self) -> None:
        """For each of the four blocks: items by block value, with all values
        that differ in at most radius // 4 bits."""
        flips = np.array([sum(1 << x for x in c) for d in range(self.radius // 4 + 1)
                          for c in combinations(range(16), d)], np.uint64)
        self.index = []
        for b in range(4):
            value = (self.prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)
            slots = (value[:, None] ^ flips).ravel().astype(np.int64)
            item = np.repeat(np.arange(len(self.prints)), len(flips)).astype(np.int32)
            order = np.argsort(slots, kind="stable")
            self.index.append((np.searchsorted(slots[order], np.arange(65537)), item[order]))

    def within(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, distance) of all items of ``size`` words within the radius."""
        rows, items = [], []
        for b, (at, item) in enumerate(self.index):
            v = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            n = at[v + 1] - at[v]
            rows.append(np.repeat(np.arange(len(v)), n))
            items.append(item[np.repeat(at[v] - np.cumsum(n) + n, n) + np.arange(n.sum())])
        row, item = np.concatenate(rows), np.concatenate(items).astype(np.int64)
        keep = self.size[item] == size
        pair = np.unique(row[keep] * len(self.ids) + item[keep])
        row, item = np.divmod(pair, len(self.ids))
        distance = np.bitwise_count(prints[row] ^ self.prints[item]).astype(np.int64)
        near = distance <= self.radius
        return row[near], item[near], distance[near]

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Places whose shingle occurs in some item."""
        at = np.flatnonzero(self.maybe[shingles >> np.uint64(44)])
        if not len(at):
            return at
        p = np.minimum(np.searchsorted(self.known, shingles[at]), len(self.known) - 1)
        return at[self.known[p] == shingles[at]]

    def matches(self, words: np.ndarray, whole: np.ndarray) -> list[tuple]:
        """(item, start word, end word, distance, similarity) of one document;
        ``whole``: the hits among its k-word shingles."""
        found: list[tuple] = []
        for k in [*self.short, self.k]:
            sizes = [k] if k < self.k else sorted({int(n) for n in self.size if n >= k})
            if len(words) < k:
                continue
            shingles = shingle_hashes(words, k)
            at = whole if k == self.k else self.hits(shingles)
            if not len(at):
                continue
            p, q = np.searchsorted(self.known, shingles[at]), np.searchsorted(self.known, shingles[at], "right")
            hit_sizes = {int(n) for lo, hi in set(zip(p.tolist(), q.tolist())) for n in self.size[self.owner[lo:hi]]}
            sums = None
            for m in sizes:
                n = min(m - k + 1, len(shingles))        # a shorter document is one window
                last = len(shingles) - n
                if m not in hit_sizes or n / (m - k + 1) < self.least:
                    continue
                mark = np.zeros(last + 2, np.int32)
                np.add.at(mark, np.clip(at - n + 1, 0, last + 1), 1)
                np.add.at(mark, np.minimum(at, last) + 1, -1)
                start = np.flatnonzero(np.cumsum(mark)[:last + 1] > 0)
                if not len(start):
                    continue
                if sums is None:
                    lo, hi = max(0, int(at[0]) - max(sizes)), min(len(shingles), int(at[-1]) + max(sizes) + 1)
                    sums = bit_sums(shingles[lo:hi])
                prints = np.concatenate([simhash(sums[s - lo + n] - sums[s - lo]) for s in np.array_split(start, len(start) // 4096 + 1)])
                row, item, distance = self.within(prints, m)
                for r, i, d in zip(row.tolist(), item.tolist(), distance.tolist()):
                    s = int(start[r])
                    sim = similarity(Counter(shingles[s:s + n].tolist()), self.bags[i])
                    if sim >= self.least:
                        found.append((i, s, min(s + m, len(words)), d, sim))
        best, taken = [], {}
        for f in sorted(found, key=lambda f: (-f[4], f[1], f[0])):
            spans = taken.setdefault(f[0], [])
            if all(f[2] <= a or f[1] >= b for a, b in spans):
                spans.append((f[1], f[2]))
                best.append(f)
        return sorted(best, key=lambda f: (f[1], self.ids[f[0]]))


def _row_matches(items: Items, texts: pa.Array):
    """(row, its matches) of the texts that have any."""
    words, at = word_hashes(texts)
    hit = doc = np.empty(0, np.int64)
    if len(words) >= items.k:
        hit = items.hits(shingle_hashes(words, items.k))
        doc = np.searchsorted(at, hit, "right") - 1
        whole = hit + items.k <= at[doc + 1]
        hit, doc = hit[whole], doc[whole]
    for i in range(len(texts)) if items.short else np.unique(doc).tolist():
        mine = hit[np.searchsorted(doc, i):np.searchsorted(doc, i, "right")] - at[i]
        found = items.matches(words[at[i]:at[i + 1]], mine)
        if found:
            yield i, found


def _scan(rows: list[tuple[int, str]], k: int, radius: int, least: float):
    names, types = [x.split()[0] for x in SCHEMA.split(", ")], (pa.int64(),) * 5 + (pa.float64(),)

    def run(batches):
        items = Items(rows, k, radius, least)
        for b in text_slices(batches):
            keys = b.column("key").to_pylist()
            out = [(keys[i], items.ids[f[0]], *f[1:]) for i, found in _row_matches(items, b.column("text")) for f in found]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    return run


def _clean(rows: list[tuple[int, str]], text: str, k: int, radius: int, least: float):
    def run(batches):
        items = Items(rows, k, radius, least)
        for b in text_slices(batches, text):
            keep = np.ones(b.num_rows, bool)
            keep[[i for i, _ in _row_matches(items, b.column(text))]] = False
            yield b.filter(pa.array(keep))
    return run


def _blocks(benchmark: DataFrame, key: str, text: str):
    """Bounded lists of (item, text), streamed partition by partition."""
    rows, words = [], 0
    for r in keyed_text(benchmark, key, text).where("key is not null").distinct().orderBy("key", "text").toLocalIterator():
        n = len(r.text.split())
        if rows and (len(rows) >= BLOCK_ITEMS or words + n > BLOCK_WORDS):
            yield rows
            rows, words = [], 0
        rows.append((r.key, r.text))
        words += n
    if rows:
        yield rows


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item_key: str = "item_id", item_text: str = "text", k: int = 5, least: float = 0.8,
               radius: int = RADIUS) -> DataFrame:
    """One row a leaked passage: ``key, item_id, start_word, end_word`` (word
    offsets, end exclusive), the fingerprints' distance and the similarity.
    Windows of one item that overlap give the best one."""
    source = keyed_text(docs, key, text)
    out = None
    for rows in _blocks(benchmark, item_key, item_text):
        part = source.mapInArrow(_scan(rows, k, radius, least), SCHEMA)
        out = part if out is None else out.union(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], SCHEMA)
    return out.withColumnRenamed("key", key)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
               item_text: str = "text", k: int = 5, least: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark passage."""
    for rows in _blocks(benchmark, item_key, item_text):
        docs = docs.mapInArrow(_clean(rows, text, k, radius, least), docs.schema)
    return docs
