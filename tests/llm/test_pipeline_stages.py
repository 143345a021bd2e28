"""The corpus pipeline against brute-force versions of its stages."""

from __future__ import annotations

import corpus_pipeline
import pytest
from test_operators import ODD, brute_components, brute_spans, shingles, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark):
    return corpus_pipeline.run(spark, SF).collect()


def test_stages_match_brute_force(spark, result):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    spoken = {i: r.text for i, r in docs.items() if any(c.isalpha() for c in r.text or "")}
    first = {i for i, (_, c) in brute_components(list(spoken.items()), 5).items() if i == c}

    def leaks(text):
        w = words(text)
        for m in items:
            own = shingles(" ".join(m), 5)
            for s in range(len(w) - len(m) + 1):
                both = len(own & shingles(" ".join(w[s:s + len(m)]), 5))
                if both and both / (2 * len(own) - both) >= 0.8:
                    return True
        return False
    kept = {i for i in first if not (any(shingles(" ".join(m), 5) & shingles(docs[i].text, 5) for m in items) and leaks(docs[i].text))}
    assert {r.doc_id for r in result} == kept and len(result) == len(kept)
    for r in result:
        text = docs[r.doc_id].text
        assert r.lossless and r.n_chars == len(r.text)
        assert not any(text[a:b] in r.text for _, a, b in brute_spans(text))
        if not any(c.isdigit() or c == "@" for c in text):
            assert r.text == text


def test_stages_keep_columns_and_odd_rows(spark):
    rows = [(0, None), (1, ""), (None, "The and of in that with here"), (2, "The and of in that with here"), (2, "The and of in that with here"),
            (3, "Mail a.b@c.de now")]
    docs = spark.createDataFrame([(i, t, "en", None, 0, "k", 1, "z") for i, t in rows], ODD)
    whole = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id + 100 as doc_id", "text", "lang", "source", "n_chars",
                                                                     "'k' as key", "1L as n", "'z' as spans")
    out = docs.union(whole)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, SF)
        assert out.columns == docs.columns, name
    ids = [r.doc_id for r in out.collect()]
    assert ids.count(2) == 2 and ids.count(None) == 1 and 0 not in ids and 1 not in ids and 3 in ids
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
