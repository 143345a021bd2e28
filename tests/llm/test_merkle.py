"""Merkle manifest: positions, brute-force trees, edge cases."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tsengine.llm import merkle, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, i long, path string"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(*fields):
    return "".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields)


def levels_of(leaves):
    out = [list(leaves)]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def path_of(levels, i):
    path = []
    for nodes in levels[:-1]:
        a = i - i % 8
        path.append(("".join(nodes[a:i]), "".join(nodes[i + 1:a + 8])))
        i //= 8
    return path


def brute(docs):
    """doc rows -> sorted result rows, from the definition."""
    def leaf(d, lower=False):
        text = d[1]
        if lower and text is not None:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        return H(framed(d[0], d[3], d[2], d[4], text))
    trees = {}
    for d in docs:
        trees.setdefault(d[2], []).append(d)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    tops, out = [], []
    for name in names:
        trees[name].sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        tops.append(levels_of([leaf(d) for d in trees[name]]))
    root = levels_of([x[-1][0] for x in tops])
    for t, name in enumerate(names):
        for i, d in enumerate(trees[name]):
            path = path_of(tops[t], i) + path_of(root, t)
            hit = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0
            node = leaf(d, lower=hit)
            for a, b in path:
                node = H(a + node + b)
            out.append((d[0], leaf(d), tops[t][-1][0], root[-1][0], H("".join(a + b for a, b in path)), node,
                        node == root[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 511, 513, 700])
def test_log_is_the_postorder_and_positions_are_closed_form(n):
    leaves = [H(str(i)) for i in range(n)]
    log, levels = merkle.append_all(leaves, merkle.depth(n)), levels_of(leaves)
    assert len(levels) - 1 == merkle.depth(n) and len(log) == sum(map(len, levels))
    at = {}
    for level, nodes in enumerate(levels):
        for j, digest in enumerate(nodes):
            at[merkle.position(level, j, n)] = digest
    assert [at[i] for i in range(len(log))] == log
    steps = merkle.sibling_path("".join(log), n, merkle.depth(n))
    assert all([s[i // 8 ** k] for k, s in enumerate(steps)] == path_of(levels, i) for i in range(n))


def run(spark, docs, tmp_path):
    spark.createDataFrame(docs, DOCS).repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    return queries.op11_merkle_manifest(spark, str(tmp_path))


def test_proofs_match_brute_force_over_hot_and_small_trees(spark, tmp_path):
    rows = [(i * 3, f"Text {i} Ünï", "en" if i % 3 else "de", "s", i, "x", 1, "y") for i in range(1_900)]
    rows += [(None, None, None, None, None, None, None, None), (None, "A", None, "s", 1, "x", 1, "y"),
             (5, "", "", "", 0, "x", 1, "y"), (5, "", "", "", 0, "x", 1, "y"), (5, "Other", "", "", 5, "x", 1, "y"),
             (6, None, "zz", None, 7, "x", 1, "y"), (-7, "LONG " * 200_000, "zz", "s", 7, "x", 1, "y")]
    got = [tuple(r) for r in run(spark, rows, tmp_path).collect()]
    want = brute(rows)
    assert sorted(got, key=repr) == want
    assert {r[-1] for r in want} == {True, False}


def test_log_entries_are_a_whole_log(spark):
    docs = spark.range(1_300).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1_290, "a").alias("lang"))
    manifest = merkle.build(docs, "lang", "doc_id", merkle.leaf_digest(docs["doc_id"]))
    for name, ids in (("+a", range(1_290)), ("", range(1_290, 1_300))):
        rows = merkle.log_entries(manifest).where(F.col("tree") == name).collect()
        levels = levels_of([H(framed(i)) for i in ids])
        want = {merkle.position(k, j, len(ids)): (k, d) for k, nodes in enumerate(levels) for j, d in enumerate(nodes)}
        assert len(rows) == len(want) and {r["position"]: (r["level"], r["digest"]) for r in rows} == want


def test_one_row_repeated_rows_and_none(spark, tmp_path):
    for k, rows in enumerate(([(1, "a", "en", "s", 1, "x", 1, "y")], [(1, "a", "en", "s", 1, "x", 1, "y")] * 600, [])):
        got = [tuple(r) for r in run(spark, rows, tmp_path / str(k)).collect()]
        assert sorted(got, key=repr) == (brute(rows) if rows else [])
