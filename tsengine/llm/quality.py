"""Quality classifier: a sparse ensemble of rules over statistics of a text.

``statistics`` are Spark expressions over the whole text (sizes, shares of
letter cases, digits, marks and symbols, repeated words and lines).  A random
forest of shallow trees is fitted to them on a bounded sample of labelled rows;
every path from a root to a node is a rule, the conjunction of its conditions
(``extract_rules``; bounds on one statistic merged, equal rules once).  A lasso
logistic regression weighs the rules' truth values and the statistics
themselves, cut at the sample's 2.5 % and 97.5 % quantiles, and leaves most at
zero.  What is left is compiled into one Spark column (``score``): scoring is a
scan without Python, joins or shuffles, and the model can be read
(``RuleModel.describe``).

``SAMPLE_ROWS`` bounds the labelled rows (those of smallest id hash); everything
else covers all rows.

Edge cases.  Null texts count as empty; empty texts have statistics of zero and
get a score like any other.  An id labelled both ways counts once each way; rows
that repeat an id are scored each.  Null ids match no label and null labels are
none.  Without labelled rows the score is 0.5, with labels of one kind that
kind's share after adding one row of each.  An empty table gives no rows; other
columns take no part.
"""

from __future__ import annotations

import dataclasses
import math
import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsengine.llm._common import save_table

SAMPLE_ROWS = 20_000
TREES = 24
DEPTH = 3
LASSO = 0.002
TAIL = 0.025


# ---------------------------------------------------------------- statistics

def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _size(text: Column) -> Column:
    return F.length(text).cast("double")


def with_statistics(df: DataFrame, text: str, keep: dict[str, Column]) -> tuple[DataFrame, list[str]]:
    """``keep`` and the statistics of every row, and the statistics' names."""
    whole = F.coalesce(df[text].cast("string"), F.lit(""))
    rows = df.select(*[c.alias(n) for n, c in keep.items()], whole.alias("_text"))
    kept = list(keep)
    rows = rows.select(
        *kept, _size(F.col("_text")).alias("_chars"),
        _size(F.regexp_replace("_text", r"\p{Lu}++", "")).alias("_not_upper"),
        F.regexp_replace("_text", r"[\p{L}\p{M}]++", "").alias("_rest"),
        F.filter(F.split("_text", r"[\x20\x09-\x0D]++"), lambda w: w != "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: F.trim(x) != "").alias("_lines"))
    rows = rows.select(
        *kept, "_chars", (F.col("_chars") - F.col("_not_upper")).alias("_upper"), _size(F.col("_rest")).alias("_others"),
        _size(F.regexp_replace("_rest", r"\p{N}++", "")).alias("_not_digit"),
        _size(F.regexp_replace("_rest", r"[.,;:'\"()-]++", "")).alias("_not_point"),
        _size(F.regexp_replace("_rest", r"[!?]++", "")).alias("_not_call"),
        _size(F.regexp_replace("_rest", r"[^\s.,;:'\"()!?\p{N}-]++", "")).alias("_not_symbol"),
        F.size("_words").cast("double").alias("words"), F.size(F.array_distinct("_words")).cast("double").alias("_kinds"),
        F.size("_lines").cast("double").alias("lines"), F.size(F.array_distinct("_lines")).cast("double").alias("_line_kinds"))
    chars, others, letters = F.col("_chars"), F.col("_others"), F.col("_chars") - F.col("_others")
    stats = {
        "words": F.col("words"),
        "lines": F.col("lines"),
        "letters_a_word": _share(letters, F.col("words")),
        "words_a_line": _share(F.col("words"), F.col("lines")),
        "letter_share": _share(letters, chars),
        "upper_share": _share(F.col("_upper"), letters),
        "digit_share": _share(others - F.col("_not_digit"), chars),
        "point_share": _share(others - F.col("_not_point"), chars),
        "call_share": _share(others - F.col("_not_call"), chars),
        "symbol_share": _share(others - F.col("_not_symbol"), chars),
        "distinct_words": _share(F.col("_kinds"), F.col("words")),
        "distinct_by_root": _share(F.col("_kinds"), F.sqrt("words")),
        "repeated_lines": _share(F.col("lines") - F.col("_line_kinds"), F.col("lines")),
    }
    return rows.select(*kept, *[c.alias(n) for n, c in stats.items()]), list(stats)


# --------------------------------------------------------------------- rules

Rule = tuple[tuple[str, str, float], ...]  # conditions (statistic, "<=" or ">", bound)

_STEP = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([^)]+)\)")


def extract_rules(forest: str, names: list[str]) -> list[Rule]:
    """The rules of all paths of a forest's printed trees."""
    rules: dict[Rule, None] = {}
    path: list[tuple[int, tuple[str, str, float]]] = []
    for line in forest.splitlines():
        if line.lstrip().startswith("Tree "):
            path = []
            continue
        step = _STEP.match(line)
        if not step:
            continue
        indent = len(step[1])
        while path and path[-1][0] >= indent:
            path.pop()
        path.append((indent, (names[int(step[3])], step[4], float(step[5]))))
        bounds: dict[tuple[str, str], float] = {}
        for _, (name, side, value) in path:
            seen = bounds.get((name, side))
            bounds[name, side] = value if seen is None else (min if side == "<=" else max)(seen, value)
        rules[tuple(sorted((n, s, v) for (n, s), v in bounds.items()))] = None
    return list(rules)


def holds(rule: Rule) -> Column:
    """The rule as a condition."""
    out = F.lit(True)
    for name, side, value in rule:
        out = out & ((F.col(name) <= value) if side == "<=" else (F.col(name) > value))
    return out


@dataclasses.dataclass
class RuleModel:
    bias: float
    rules: list[tuple[Rule, float]]                      # with weights other than 0
    lines: list[tuple[str, float, float, float]]         # statistic, lower and upper cut, weight
    candidates: int = 0

    def margin(self) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        for name, low, high, weight in self.lines:
            total = total + F.lit(weight) * F.greatest(F.lit(low), F.least(F.lit(high), F.col(name)))
        return total

    def describe(self) -> list[str]:
        """The rules as text, by weight."""
        out = [(w, " and ".join(f"{n} {s} {v:.4g}" for n, s, v in r)) for r, w in self.rules]
        out += [(w, f"{n} within [{a:.4g}, {b:.4g}]") for n, a, b, w in self.lines]
        return [f"{w:+.3f}  {text}" for w, text in sorted(out, key=lambda x: -abs(x[0]))]


# ------------------------------------------------------------ fit and score

def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, train: Column, rows: int) -> tuple[DataFrame, list[str]]:
    """Statistics and label of at most ``rows`` labelled rows (and of repeats of their ids)."""
    given = (labels.select(labels[key].cast("long").alias("key"), labels[label].cast("double").alias("label"))
             .where(F.col("key").isNotNull() & F.col("label").isin(0.0, 1.0)).where(train).distinct()
             .orderBy(F.xxhash64("key"), "key", "label").limit(rows))
    texts = docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text"))
    chosen = texts.join(F.broadcast(given), "key")  # at most `rows` ids and labels
    return with_statistics(chosen, "text", {"key": F.col("key"), "label": F.col("label")})


def fit(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", text: str = "text",
        label: str = "quality", rows: int = SAMPLE_ROWS) -> RuleModel:
    """A model of ``label`` (0 or 1).  ``train`` is a condition on ``key`` that
    labelled rows must meet."""
    chosen, names = _sample(docs, labels, key, text, label, train, rows)
    # the sample is bounded: one sorted file makes the fit the same on any cluster
    chosen = save_table(chosen.repartition(1).sortWithinPartitions("key", "label", *names), "quality-sample")
    counts = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    if len(counts) < 2:
        ones, total = counts.get(1.0, 0), sum(counts.values())
        return RuleModel(math.log((ones + 1) / (total - ones + 1)), [], [])
    data = chosen.select("label", array_to_vector(F.array(*names)).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=5, subsamplingRate=0.7,
                                    featureSubsetStrategy="0.5", seed=7).fit(data)
    rules = extract_rules(forest.toDebugString, names)
    cuts = chosen.approxQuantile(names, [TAIL, 1 - TAIL], 0.001)
    terms = [F.when(holds(r), 1.0).otherwise(0.0) for r in rules]
    terms += [F.greatest(F.lit(a), F.least(F.lit(b), F.col(n))) for n, (a, b) in zip(names, cuts)]
    table = save_table(chosen.select("label", array_to_vector(F.array(*terms)).alias("features")).coalesce(1), "quality-rules")
    lasso = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, maxIter=200, standardization=True).fit(table)
    weight = lasso.coefficients.toArray().tolist()
    return RuleModel(float(lasso.intercept), [(r, w) for r, w in zip(rules, weight) if w],
                     [(n, a, b, w) for n, (a, b), w in zip(names, cuts, weight[len(rules):]) if w], len(rules))


def score(docs: DataFrame, model: RuleModel, text: str, keep: dict[str, Column]) -> DataFrame:
    """``keep``, ``score`` (0 to 1) and the statistics of every row."""
    rows, names = with_statistics(docs, text, keep)
    return rows.select(*keep, (1 / (1 + F.exp(-model.margin()))).alias("score"), *names)
