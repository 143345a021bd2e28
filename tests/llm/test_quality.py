"""Quality classifier: statistics by hand, rules against tree paths, held-out accuracy."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tsengine.llm import quality, queries

DOCS = "doc_id long, text string, score double, words string, lines long, label int"


def test_statistics_by_hand(spark):
    text = "One two TWO 12.\nOne two TWO 12.\n\n$$! Éa"
    rows = [(1, text, 0.0, "w", 1, 0), (2, "", 0.0, "w", 1, 0), (3, None, 0.0, "w", 1, 0), (4, " \n ", 0.0, "w", 1, 0)]
    got, names = quality.with_statistics(spark.createDataFrame(rows, DOCS), "text", {"doc_id": F.col("doc_id")})
    got = {r["doc_id"]: r.asDict() for r in got.collect()}
    n, letters = len(text), 20
    want = {"words": 10, "lines": 3, "letters_a_word": letters / 10, "words_a_line": 10 / 3, "letter_share": letters / n,
            "upper_share": 9 / letters, "digit_share": 4 / n, "point_share": 2 / n, "call_share": 1 / n, "symbol_share": 2 / n,
            "distinct_words": 6 / 10, "distinct_by_root": 6 / math.sqrt(10), "repeated_lines": 1 / 3}
    assert set(names) == set(want)
    assert all(got[1][k] == pytest.approx(v) for k, v in want.items())
    assert all(got[i][k] == 0 for i in (2, 3) for k in names)
    assert got[4]["letter_share"] == got[4]["words"] == 0


def test_rules_are_the_paths_of_the_trees(spark):
    rnd = random.Random(4)
    rows = [(float(a > 3 and b < 5), a, b) for a, b in ((rnd.random() * 9, rnd.random() * 9) for _ in range(400))]
    df = spark.createDataFrame([(y, Vectors.dense(a, b), a, b) for y, a, b in rows], ["label", "features", "a", "b"])
    forest = RandomForestClassifier(numTrees=5, maxDepth=3, seed=1).fit(df)
    rules = quality.extract_rules(forest.toDebugString, ["a", "b"])
    assert len(set(rules)) == len(rules) > 5
    # by leaf: rows of every tree meet exactly one leaf's rule, whose prediction is the tree's
    flat = df.select("a", "b", *[quality.holds(r).alias(f"r{i}") for i, r in enumerate(rules)]).collect()
    for got in flat[:50]:
        for i, rule in enumerate(rules):
            true = all((got[n] <= v) if s == "<=" else (got[n] > v) for n, s, v in rule)
            assert got[f"r{i}"] == true
    depth_one = [r for r in rules if len(r) == 1]
    assert {s for r in depth_one for _, s, _ in r} == {"<=", ">"}


def test_score_is_the_weighted_sum_of_rules(spark):
    model = quality.RuleModel(0.5, [((("words", ">", 2.0),), 1.5), ((("lines", "<=", 1.0), ("words", "<=", 2.0)), -2.0)],
                              [("words", 1.0, 4.0, 0.25)])
    df = spark.createDataFrame([(1, "a b c d e f", 0.0, "w", 1, 0), (2, None, 0.0, "w", 1, 0)], DOCS)
    got = {r["id"]: r["score"] for r in quality.score(df, model, "text", {"id": F.col("doc_id")}).collect()}
    assert got[1] == pytest.approx(1 / (1 + math.exp(-(0.5 + 1.5 + 1.0))))
    assert got[2] == pytest.approx(1 / (1 + math.exp(-(0.5 - 2.0 + 0.25))))
    assert len(model.describe()) == 3


def test_few_or_one_sided_labels(spark):
    docs = spark.createDataFrame([(i, t, 0.0, "w", 1, 0) for i, t in enumerate(["a b", None, "", "x " * 300_000])], DOCS)
    schema = "doc_id long, quality int, label string"
    for rows, share in (([], 0.5), ([(0, 1, "x"), (1, 1, "x"), (None, 0, "x"), (2, None, "x")], 0.75), ([(9, 0, "x")], 0.5)):
        model = quality.fit(docs, spark.createDataFrame(rows, schema), F.lit(True))
        got = quality.score(docs, model, "text", {"id": F.col("doc_id")}).collect()
        assert len(got) == 4 and all(r["score"] == pytest.approx(share) for r in got)
    none = quality.score(docs.where("false"), model, "text", {"id": F.col("doc_id")})
    assert none.collect() == []


def test_sample_is_bounded_and_keeps_to_the_training_part(spark):
    docs = spark.createDataFrame([(i, "some text", 0.0, "w", 1, 0) for i in range(50)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(50)] * 2, "doc_id long, quality int, label string")
    rows, _ = quality._sample(docs, labels, "doc_id", "text", "quality", F.col("key") >= 20, 10)
    keys = [r["key"] for r in rows.collect()]
    assert len(keys) == 10 and min(keys) >= 20


def test_held_out_labels_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op12_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows)
    kept = [r["predicted"] for r in rows if r["quality"] == 1]
    assert len(rows) > 500 and right / len(rows) >= 0.99 and sum(kept) / len(kept) >= 0.99
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
