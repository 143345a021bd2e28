"""Spelling variants: pairs, lists of any size, and the query against brute force."""

from __future__ import annotations

import collections
import random
import re
import zlib

import numpy as np
import pytest

from tsengine.llm import queries, variants

DOCS = "doc_id long, text string, word string, n long, list string, m long, root string"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = variants._common(a, b)
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute_groups(n_of, ratio=5):
    out = {}
    for w, n in n_of.items():
        others = [x for x in n_of if near(w, x)]
        best = min(others, key=lambda x: (-n_of[x], x), default=None)
        form = best if best is not None and n_of[best] >= ratio * n else None
        out[w] = (form, n, len(others), n_of[form] if form else None)

    def root(w):
        while out[w][0]:
            w = out[w][0]
        return w
    return sorted(((w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items()), key=repr)


def brute_words(docs):
    count = collections.Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def test_near_pairs_of_several_lists():
    rnd = random.Random(1)
    for _ in range(40):
        lists = [sorted({"".join(rnd.choice("abé") for _ in range(rnd.randrange(8))) for _ in range(rnd.randrange(1, 90))})
                 for _ in range(3)]
        opens = np.cumsum([0, *map(len, lists[:-1])]).tolist()
        i, j = variants.near_pairs(sum(lists, []), opens)
        want = [(o + a, o + b) for o, ws in zip(opens, lists) for a in range(len(ws)) for b in range(a + 1, len(ws))
                if near(ws[a], ws[b])]
        assert sorted(zip(i.tolist(), j.tolist())) == want


@pytest.mark.parametrize("limit", [1024, 3])
def test_groups_match_brute_force_however_lists_are_cut(spark, monkeypatch, limit):
    monkeypatch.setattr(variants, "LIST_WORDS", limit)
    monkeypatch.setattr(variants, "SEARCH_CHARS", 200)
    rnd = random.Random(5)
    base = ["aaaaaa", "aaaaaaa", "aaaaab", "abcdef", "abcdefg", "straßenbahn", "élévation", "bcdefgh"]
    words = set(base)
    for _ in range(220):
        w = list(rnd.choice(sorted(words)))
        at = rnd.randrange(len(w) + 1)
        w[at:at + rnd.randrange(2)] = [rnd.choice("abéz")] * rnd.randrange(2)
        if 6 <= len(w) <= 14:
            words.add("".join(w))
    n_of = {w: rnd.choice([5, 6, 7, 30, 200, 2_000, 10**12]) for w in sorted(words)}
    got = variants.group(spark.createDataFrame(list(n_of.items()), "word string, n long"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_groups(n_of)


def test_query_matches_brute_force(spark, tmp_path):
    rnd = random.Random(2)
    stems = ["letter", "Letters", "LETTER", "lettér", "Überraschung", "überraschung", "étoile", "étoiles", "short", "a" * 5_000,
             "a" * 5_001, "seven×x", "ﬁxture", "naïveté"]
    docs = [(i, " ".join(rnd.choices(stems, k=60)) + rnd.choice([".", "1x", "\n--"])) for i in range(300)]
    docs += [(None, "letter letters"), (301, None), (302, ""), (5, docs[5][1]), (303, "letter" * 50_000)]
    rows = [(k, t, "w", 1, "l", 2, "r") for k, t in docs]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_spelling_variants(spark, str(tmp_path)).select("word", "form", "root", "n", "n_near", "form_n")
    want = brute_groups(brute_words(docs))
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert any(w[1] and w[1] != w[2] for w in want) or any(w[1] for w in want)


def test_no_words(spark, tmp_path):
    spark.createDataFrame([(1, "few short words", "w", 1, "l", 2, "r")], DOCS).write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert queries.op13_spelling_variants(spark, f"{tmp_path}/a").collect() == []
    assert queries.op13_spelling_variants(spark, f"{tmp_path}/b").collect() == []
