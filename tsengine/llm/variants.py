"""Spelling variants: words one edit apart, found in sorted lists.

Words.  Maximal runs of letters (``LETTERS``), A-Z lower-cased, counted over all
texts; words of at least 6 code points and 5 occurrences form the vocabulary.
Two are near if one code point is inserted, deleted or replaced.

Search.  The adjacent common prefix lengths (LCP) of a sorted list tell the
ranges of words that share a prefix.  For such a prefix the row of the edit
matrix (three cells, the band of one edit) against a later word is computed once
and serves the whole range; the ranges of longer prefixes in it go on from that
row.  A word whose band exceeds one edit skips the range.  All ranges of one
depth advance together as arrays (``near_pairs``).

Lists.  Of a near pair whose shorter word has ``m`` code points, either the
first ``m // 2`` or the last ``m - m // 2`` are equal.  So words are dealt to
lists by ``m`` (their length, or one less) and by either piece, and a list
holds what lies between equal pieces.  A list of more than ``LIST_WORDS`` words
is halved the same way again: its middle, too, has one half in common.  That
ends at middles of one code point, whose number is bounded by the alphabet, so
no list grows without bound and no word is left out.  Where the common prefix
of a pair ends tells which of the two halves has it, so every pair is found
once (``below``), without removing duplicates afterwards.

A list gives one row a word: how many near words it has there, and the best.
Rows are summed by word.  Roots follow by doubling: a root's root replaces it
until nothing changes; forms get five times as frequent, so the chains are short.

Edge cases.  Null and empty texts have no words; a null id counts as empty text
in the checksum; rows that repeat an id count each; texts are read whole,
whatever their length; an empty table gives no rows; other columns take no part.
Ties of the best near word go to the smallest in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsengine.llm._common import bound_batches, give_back, save_table

LETTERS = "[A-Za-zÀ-ÿ]"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5            # a form is at least so many times as frequent
LIST_WORDS = 1024
SEARCH_CHARS = 1 << 15
_ANY = 1 << 20       # no upper bound on a pair's common prefix
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---------------------------------------------------------------- vocabulary

def runs(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """``(id, run)``: every maximal run of at least ``least`` letters, A-Z lower-cased."""
    found = F.regexp_extract_all(docs[text], F.lit(f"{LETTERS}{{{least},}}+"), F.lit(0))
    rows = docs.select(F.coalesce(docs[key].cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    return rows.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))


def damaged(key: Column, run: Column, divisor: int) -> Column:
    """``run`` less one code point where ``divisor`` divides the checksum of key and run."""
    h = F.crc32(F.concat(key, F.lit(":"), run))
    k = (h % F.length(run)).cast("int")
    return F.when(h % divisor == 0, F.concat(F.substring(run, F.lit(1), k), F.substring(run, k + 2, F.length(run)))
                  ).otherwise(run)


def count_words(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of one column of words, without short and rare ones."""
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


# --------------------------------------------------------------- sorted lists

def near_pairs(words: Sequence[str], opens: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """All ``(i, j)``, ``i < j``, of one list whose words are one edit apart.

    ``words`` holds one or more lists, one behind another (``opens``: where each
    begins), the words of a list distinct and sorted in code-point order.
    """
    count = len(words)
    length = np.fromiter(map(len, words), np.int64, count)
    offset = np.zeros(count, np.int64)
    np.cumsum(length[:-1] + 2, out=offset[1:])
    code = np.frombuffer("".join(f"{w}\0\0" for w in words).encode("utf-32-le"), np.uint32)
    lcp = np.fromiter((_common(x, y) for x, y in zip(["", *words[:-1]], words)), np.int64, count)
    lcp[opens] = -1
    # A node is the range of words that share a prefix: it starts where the LCP is shorter.
    # An entry is a word behind the start, within one edit of the prefix, and its three cells.
    starts = np.asarray(opens, np.int64)
    node = np.searchsorted(starts, np.arange(count), "right") - 1
    word = np.arange(count)
    low, on, high = np.full(count, 2, np.int8), np.zeros(count, np.int8), np.ones(count, np.int8)
    pairs = []
    d = 0
    while len(word):
        ended = np.flatnonzero((length[starts[node]] == d) & (word > starts[node]))
        if len(ended):
            apart = length[word[ended]] - d
            cell = np.select([apart == -1, apart == 0, apart == 1], [low[ended], on[ended], high[ended]], 2)
            pairs.append(np.stack([starts[node[ended]], word[ended]])[:, cell == 1])
        # the ranges of the prefixes one longer, by the range that holds them
        longer = np.flatnonzero((lcp <= d) & (length > d))
        held = np.searchsorted(starts, longer, "right") - 1
        children = np.bincount(held, minlength=len(starts))
        first = np.cumsum(children) - children
        times = children[node]
        at = np.repeat(np.arange(len(node)), times)
        child = first[node][at] + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        start, j = longer[child], word[at]
        keep = (j > start) & (length[j] >= d)
        at, child, start, j = at[keep], child[keep], start[keep], j[keep]
        c, q = code[offset[start] + d], offset[j] + d
        a = on[at] + np.int8(1)
        if d:
            a = np.minimum(a, low[at] + (code[q - 1] != c))
        b = np.minimum(np.minimum(on[at] + (code[q] != c), high[at] + np.int8(1)), a + np.int8(1))
        e = np.minimum(high[at] + (code[q + 1] != c), b + np.int8(1))
        d += 1
        live = np.flatnonzero(np.minimum(np.minimum(a, b), e) <= 1)
        node, word, starts = child[live], j[live], longer
        low, on, high = a[live], b[live], e[live]
    return tuple(np.concatenate(pairs, axis=1)) if pairs else (np.empty(0, np.int64), np.empty(0, np.int64))


def summaries(rows: dict[str, list], opens: list[int]):
    """Of the lists in ``rows``: the words that have near ones, how many, and the
    best (its count, its word).  Pairs whose shorter word is longer than the
    list's ``m``, or whose common prefix reaches its ``below``, belong to others."""
    i, j = near_pairs(rows["middle"], opens)
    words, counts = rows["word"], np.array(rows["n"], np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    shared = np.fromiter((_common(words[x], words[y]) for x, y in zip(i.tolist(), j.tolist())), np.int64, len(i))
    keep = (np.minimum(size[i], size[j]) == np.array(rows["m"], np.int64)[i]) & (shared < np.array(rows["below"], np.int64)[i])
    i, j = i[keep], j[keep]
    rank = np.empty(len(words), np.int64)  # by code points
    rank[np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)] = np.arange(len(words))
    me, other = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.lexsort((rank[other], -counts[other], me))
    me, other = me[order], other[order]
    first = np.flatnonzero(np.r_[True, me[1:] != me[:-1]][:len(me)])
    near = np.diff(np.r_[first, len(me)])
    return ([words[x] for x in me[first].tolist()], near, counts[other[first]],
            [words[x] for x in other[first].tolist()])


def _common(a: str, b: str) -> int:
    k = 0
    for x, y in zip(a, b):
        if x != y:
            break
        k += 1
    return k


_FOUND = "word string, n_near long, form_n long, form string"


def _search_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by list and middle; a list may span batches.  Whole lists
    are searched together, about ``SEARCH_CHARS`` at a time."""
    names = ("middle", "word", "n", "m", "below")
    held: dict[str, list] = {x: [] for x in names}
    opens: list[int] = []
    last, chars = None, 0

    def searched(upto):
        part = {x: held[x][:upto] for x in names}
        for x in names:
            del held[x][:upto]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            summaries(part, [x for x in opens if x < upto]), (pa.string(), pa.int64(), pa.int64(), pa.string()))],
            names=["word", "n_near", "form_n", "form"])

    for batch in batches:
        rows = {x: batch.column(x).to_pylist() for x in names}
        for at, name in enumerate(batch.column("list").to_pylist()):
            if name != last:
                if chars > SEARCH_CHARS:
                    yield searched(len(held["word"]))
                    opens, chars = [], 0
                opens.append(len(held["word"]))
                last = name
            for x in names:
                held[x].append(rows[x][at])
            chars += len(rows["middle"][at])
    if held["word"]:
        yield searched(len(held["word"]))
    give_back()


# ---------------------------------------------------------------- Spark side

def _halved(rows: DataFrame) -> DataFrame:
    """Every row twice: with the first half of the middle fixed, and with the last.
    ``a`` and ``b`` are the code points fixed before and behind the middle."""
    k = F.col("m") - F.col("a") - F.col("b")
    half = F.floor(k / 2).cast("int")
    front = F.struct((F.col("a") + half).alias("a"), F.col("b"), F.col("below"))
    back = F.struct(F.col("a"), (F.col("b") + k - half).alias("b"), (F.col("a") + half).alias("below"))
    rows = rows.withColumn("to", F.explode(F.array(front, back)))
    size = F.length("word")
    rows = rows.select("word", "n", "m", "to.a", "to.b", "to.below")
    return rows.withColumn("list", F.concat_ws(":", "m", "a", "b", "below", F.substring("word", F.lit(1), F.col("a")),
                                               F.substring("word", size - F.col("b") + 1, F.col("b"))))


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``(word, n_near, best)`` of every word of ``(word, n)``; ``best`` is the
    near word of largest count as ``(form_n, form)``, null without near words."""
    bound_batches(vocabulary.sparkSession)
    size = F.length("word")
    # as the shorter word (or one of equal ones), and as the longer one
    roles = F.explode(F.array(size, size - 1)).alias("m")
    rows = vocabulary.select("word", "n", roles).where(F.col("m") >= MIN_LENGTH)
    rows = rows.withColumn("a", F.lit(0)).withColumn("b", F.lit(0)).withColumn("below", F.lit(_ANY))
    ready = []
    while True:
        rows = _halved(rows)
        sizes = rows.groupBy("list", (F.col("m") - F.col("a") - F.col("b")).alias("k")).agg(F.count(F.lit(1)).alias("words"))
        large = save_table(sizes.where((F.col("words") > LIST_WORDS) & (F.col("k") > 1)).select("list"), "variant-lists")
        if large.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(large, "list", "left_anti"))
        rows = save_table(rows.join(large, "list", "left_semi").drop("list"), "variant-rows")
    lists = ready[0]
    for more in ready[1:]:
        lists = lists.unionByName(more)
    middle = F.substring("word", F.col("a") + 1, F.length("word") - F.col("a") - F.col("b"))
    lists = lists.select("list", "m", "below", middle.alias("middle"), "word", "n")
    found = lists.repartition("list").sortWithinPartitions("list", "middle").mapInArrow(_search_lists, _FOUND)
    none = F.lit(None).cast("long")
    every = vocabulary.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.alias("form_n"),
                              F.lit(None).cast("string").alias("form"))
    both = every.unionByName(found.withColumn("n", none))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), F.col("form"))))
    return both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))


def group(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``(word, n)``."""
    fit = -F.col("best.less") >= ratio * F.col("n")
    words = save_table(near_words(vocabulary).select(
        "word", "n", "n_near", F.when(fit, F.col("best.form")).alias("form"),
        F.when(fit, -F.col("best.less")).alias("form_n")), "variant-words")
    roots = words.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        next_ = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = save_table(roots.join(next_, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variant-roots")
        if roots.where("moved").isEmpty():
            break
        roots = roots.drop("moved")
    return (words.join(roots.select("word", "root"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
