"""Order statistics and counts beside a moving threshold over expanding windows.

A window that ends at row ``t`` holds the rows up to ``t``.  Two questions about
it are answered for all rows at once, in Spark expressions only:

* select: which value is the ``k``-th smallest (median, quantiles);
* count: how many values lie below a threshold that moves with the window
  (shares beside the mean, beyond ``r`` standard deviations).

Every value has a rank in its whole series (by value, then position).  Ranks
form a tree of fan-out ``FAN``: a node is a class of ranks, its children cut it
into ``FAN`` classes.  A question starts at the root and moves down one level a
step; at a node it needs, for every child, how many rows up to ``t`` are in it or
in a child before it.  ``select`` enters the child where the running total
exceeds ``k``; ``count`` enters the child that holds the threshold's rank and adds
what lies before.  At the bottom a node is one value.

These totals are running sums over a node's rows and questions in order of
position, taken within blocks of ``BLOCK_ROWS`` positions and completed from a
table of the blocks' totals (of which there are none where a series is one
block).  So a task sorts the rows and questions of one node
in one block: no task holds a series or a window's rows, however long the series
is, and the data shuffled are rows and questions once a level, of which there
are ``log(rows) / log(FAN)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsengine.functions.native import native_features
from tsengine.operators.rank import number_rows, running_sum
from tsengine.operators.roll import with_positions
from tsengine.session import materialize

FAN = 16
_SLOTS, _BITS = 4, 15             # counters in a 64-bit number, and their width
BLOCK_ROWS = (1 << _BITS) - 1

ORDERED = frozenset({"median", "quantile", "symmetry_looking", "count_above_mean", "count_below_mean",
                     "ratio_beyond_r_sigma"})
SELECT, COUNT = 0, 1


def levels_for(rows: int) -> int:
    """Levels of a tree whose bottom has more than ``rows`` nodes."""
    levels, nodes = 1, FAN
    while nodes <= rows:
        levels, nodes = levels + 1, nodes * FAN
    return levels


def answer(points: DataFrame, questions: DataFrame, rows: int, block_rows: int) -> DataFrame:
    """Answers of ``questions (_v, _pos, _ask, _kind, _arg)`` over ``points (_v,
    _pos, _r)``, positions and ranks from 0; no series has more than ``rows``.

    ``_arg`` is the wanted place (select) or a rank (count).  ``_node`` is the
    rank of the selected value, ``_sum`` the points up to ``_pos`` whose rank is
    less than ``_arg``.
    """
    asked = questions.select("_v", "_pos", "_ask", "_kind", "_arg", F.lit(0).cast("bigint").alias("_node"),
                             F.lit(0).cast("bigint").alias("_sum"))
    if not 0 < block_rows < 1 << _BITS:
        raise ValueError(f"block_rows must be in 1..{(1 << _BITS) - 1}")
    levels = levels_for(rows)
    for level in range(levels):
        width = FAN ** (levels - 1 - level)
        if rows <= block_rows:      # one block a series: nothing lies before it
            asked = _descend(points, asked, width, block_rows, None)
        else:
            asked = materialize(asked)      # read twice: for the blocks' totals and for the step
            asked = _descend(points, asked, width, block_rows, _totals_before(points, asked, width, block_rows))
    return asked


_GROUP = ["_v", "_node", "_b"]


def _packed() -> dict[str, str]:
    """By name: a point's share in the counters "rows in children 0..i of its
    node", four of 15 bits a number (a block has fewer than 2**15 points)."""
    out = {}
    for k in range(-(-(FAN - 1) // _SLOTS)):
        slots = range(k * _SLOTS, min((k + 1) * _SLOTS, FAN - 1))
        shares = (sum(1 << _BITS * (i - k * _SLOTS) for i in slots if child <= i) for child in range(FAN))
        out[f"_p{k}"] = f"array({', '.join(f'{x}L' for x in shares)})[_child]"
    return out


def _counters() -> list[str]:
    """The counters of children 0..i, unpacked."""
    return [f"(shiftright(_p{i // _SLOTS}, {i % _SLOTS * _BITS}) & {(1 << _BITS) - 1})" for i in range(FAN - 1)]


def _rows_of(points: DataFrame, width: int, block_rows: int) -> DataFrame:
    return points.selectExpr("_v", "_pos", f"_r div {width * FAN} as _node", f"cast(_r div {width} % {FAN} as int) as _child",
                             f"_pos div {block_rows} as _b")


def _totals_before(points: DataFrame, asked: DataFrame, width: int, block_rows: int) -> DataFrame:
    """Totals of the blocks before, for every node and block with questions."""
    totals = _rows_of(points, width, block_rows).groupBy(*_GROUP).agg(*[F.expr(f"sum({f}) as {p}") for p, f in _packed().items()])
    here = asked.selectExpr("_v", "_node", f"_pos div {block_rows} as _b", "true as _asked").distinct()
    frame = "over (partition by _v, _node order by _b rows between unbounded preceding and 1 preceding)"
    return (totals.join(here, _GROUP, "full")
            .selectExpr(*_GROUP, "_asked", *[f"coalesce(sum({c}) {frame}, 0L) as _t{i}" for i, c in enumerate(_counters())])
            .where("_asked").drop("_asked"))


def _descend(points: DataFrame, asked: DataFrame, width: int, block_rows: int, totals: DataFrame | None) -> DataFrame:
    """One level: from nodes of ``FAN * width`` ranks to nodes of ``width``."""
    union = (_rows_of(points, width, block_rows)
             .selectExpr(*_GROUP, "_pos", "0 as _q", "_child", "cast(null as int) as _ask", "cast(null as int) as _kind",
                         "cast(null as bigint) as _arg", "cast(null as bigint) as _sum")
             .unionByName(asked.selectExpr("_v", "_node", f"_pos div {block_rows} as _b", "_pos", "1 as _q",
                                           f"{FAN - 1} as _child", "_ask", "_kind", "_arg", "_sum")))     # counts nowhere
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frame = "over (partition by _v, _node, _b order by _pos, _q rows between unbounded preceding and current row)"
    counted = union.repartition(parts, *_GROUP).selectExpr(
        "*", *[f"sum({f}) {frame} as {p}" for p, f in _packed().items()]).where("_q = 1")
    before = _counters()
    if totals is not None:
        counted = counted.join(totals, _GROUP)
        before = [f"{c} + _t{i}" for i, c in enumerate(before)]
    # entry i is what lies before child i
    counted = counted.selectExpr("_v", "_pos", "_ask", "_kind", "_arg", "_sum", "_node", f"array(0L, {', '.join(before)}) as _before")
    wanted = " + ".join(f"cast(_before[{i}] <= _arg as int)" for i in range(1, FAN))
    counted = counted.selectExpr("*", f"case when _kind = {SELECT} then {wanted} else cast(_arg div {width} % {FAN} as int) end as _child")
    return counted.selectExpr(
        "_v", "_pos", "_ask", "_kind",
        f"case when _kind = {SELECT} then _arg - _before[_child] else _arg end as _arg", f"_node * {FAN} + _child as _node",
        f"case when _kind = {SELECT} then _sum else _sum + _before[_child] end as _sum")


def threshold_ranks(points: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``_arg`` for ``thresholds (_v, _pos, _ask, _at, _inclusive)``: the points of
    the whole series at most (inclusive) or less than ``_at``."""
    none = F.lit(None)
    both = (points.select("_v", F.col("_xd").alias("_at"), F.lit(0).alias("_side"), F.lit(1).alias("_w"),
                          none.cast("bigint").alias("_pos"), none.cast("int").alias("_ask"))
            .unionByName(thresholds.select("_v", "_at", F.when(F.col("_inclusive"), 1).otherwise(-1).alias("_side"),
                                           F.lit(0).alias("_w"), "_pos", "_ask")))
    ranked = running_sum(both, ["_v"], ["_at", "_side"], "_w", "_arg")
    return ranked.where("_side <> 0").select("_v", "_pos", "_ask", F.lit(COUNT).alias("_kind"), "_arg")


def _places(q: Column) -> tuple[Column, Column]:
    """Places of the two values that a quantile lies between, in ``_n`` sorted ones."""
    at = (F.col("_n") - 1) * q
    low = F.floor(at)
    return low, F.least(low + 1, F.col("_n") - 1)


def ordered_features(series: DataFrame, specs: Sequence[tuple], variable: str = "variable", order: str = "datetime",
                     value: str = "value", block_seconds: int = 7 * 86_400, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Long features ``variable, datetime, feature, value`` of the calculators in :data:`ORDERED`."""
    rows = series.select(F.col(variable).alias("_v"), F.col(order).alias("_t"), F.col(value).alias("_x"))
    rows = with_positions(rows, "_t", ["_v"], block_seconds, "_pos").withColumn("_xd", F.col("_x").cast("double"))
    points = materialize(number_rows(rows, ["_v"], ["_xd", "_pos"], "_r"))
    most = points.agg(F.max("_r")).first()[0]

    calcs = {s[0] for s in specs}
    ends = points.select("_v", "_t", "_pos", (F.col("_pos") + 1).alias("_n"))
    moments = None
    if calcs - {"median", "quantile"}:
        moments = _moments(series, ends, variable, order, value, block_seconds)

    quantiles = sorted({s[1]["q"] for s in specs if s[0] == "quantile"})
    if calcs & {"median", "symmetry_looking"}:
        quantiles = [None, *quantiles]              # None: the median
    asks = []
    for i, q in enumerate(quantiles):
        low, high = _places(F.lit(0.5 if q is None else q))
        # the median of an odd count is one value: its second question is left out
        asks += [(2 * i, low), (2 * i + 1, high if q is not None else F.when(F.col("_n") % 2 == 0, high))]
    questions, column = [], {}
    if asks:
        wanted = F.array(*[F.struct(F.lit(i).alias("_ask"), k.cast("bigint").alias("_arg")) for i, k in asks])
        wanted = F.explode(F.filter(wanted, lambda w: w["_arg"].isNotNull()))
        questions.append(ends.select("_v", "_pos", wanted.alias("_w")).select(
            "_v", "_pos", "_w._ask", F.lit(SELECT).alias("_kind"), "_w._arg"))
    bounds = _bounds(specs)
    if bounds:
        first = 2 * len(quantiles)
        column = {name: first + i for i, name in enumerate(bounds)}
        at = F.explode(F.array(*[F.struct(F.lit(column[name]).alias("_ask"), c.alias("_at"), F.lit(inclusive).alias("_inclusive"))
                                 for name, (c, inclusive) in bounds.items()]))
        thresholds = moments.select("_v", "_pos", at.alias("_w")).select("_v", "_pos", "_w._ask", "_w._at", "_w._inclusive")
        questions.append(threshold_ranks(points, thresholds))
    every = questions[0] if len(questions) == 1 else questions[0].unionByName(questions[1])
    answers = answer(points, every, 1 + (most or 0), block_rows)
    # a selected node is a rank: look its value up; a count is the answer itself
    # (below 0 there is no rank; distinct values keep the join from piling counts up under one key)
    looked_up = answers.withColumn("_r", F.when(F.col("_kind") == SELECT, F.col("_node")).otherwise(-1 - F.col("_pos")))
    found = looked_up.join(points.select("_v", "_r", "_xd"), ["_v", "_r"], "left").select(
        "_v", "_pos", "_ask", F.coalesce("_xd", F.col("_sum").cast("double")).alias("_y"))
    n_asks = 2 * len(quantiles) + len(bounds)
    wide = found.groupBy("_v", "_pos").agg(*[F.expr(f"max(_y) filter (where _ask = {i}) as _a{i}") for i in range(n_asks)])
    wide = wide.join(ends if moments is None else moments, ["_v", "_pos"])
    feats = [(s[2], _formula(s, quantiles, column)) for s in specs]
    wide = wide.select("_v", "_t", *[c.cast("double").alias(f"_f{i}") for i, (_, c) in enumerate(feats)])
    long = wide.unpivot(["_v", "_t"], [f"_f{i}" for i in range(len(feats))], "_k", "value")
    names = F.create_map(*[x for i, (name, _) in enumerate(feats) for x in (F.lit(f"_f{i}"), F.lit(name))])
    return long.select(F.col("_v").alias(variable), F.col("_t").alias(order),
                       F.concat(F.col("_v"), F.lit("__"), names[F.col("_k")]).alias("feature"), "value")


def _moments(series, ends, variable, order, value, block_seconds) -> DataFrame:
    """``ends`` with the mean, deviation and range of every window."""
    need = ["mean", "standard_deviation", "maximum", "minimum"]
    long = native_features(series, [(c, None, c) for c in need], variable, order, value, block_seconds)
    wide = long.groupBy(F.col(variable).alias("_v"), F.col(order).alias("_t")).agg(
        *[F.max(F.when(F.col("feature").endswith(f"__{c}"), F.col("value"))).alias(f"_{c}") for c in need])
    return materialize(ends.join(wide, ["_v", "_t"]))


def _bounds(specs) -> dict[tuple, tuple[Column, bool]]:
    """Thresholds by name, and whether values equal to them count as below."""
    out: dict[tuple, tuple[Column, bool]] = {}
    for calc, params, _ in specs:
        if calc == "count_above_mean":
            out["mean", True] = (F.col("_mean"), True)
        elif calc == "count_below_mean":
            out["mean", False] = (F.col("_mean"), False)
        elif calc == "ratio_beyond_r_sigma":
            r = float(params["r"])
            out[r, True] = (F.col("_mean") + r * F.col("_standard_deviation"), True)
            out[r, False] = (F.col("_mean") - r * F.col("_standard_deviation"), False)
    return out


def _formula(spec, quantiles, column) -> Column:
    calc, params, _ = spec
    if calc in ("median", "symmetry_looking"):
        i = quantiles.index(None)
        a, b = F.col(f"_a{2 * i}"), F.col(f"_a{2 * i + 1}")
        median = F.when(F.col("_n") % 2 == 1, a).otherwise((a + b) / 2)
        if calc == "median":
            return median
        near = F.abs(F.col("_mean") - median) < float(params["r"]) * (F.col("_maximum") - F.col("_minimum"))
        return near.cast("double")
    if calc == "quantile":
        i = quantiles.index(params["q"])
        a, b = F.col(f"_a{2 * i}"), F.col(f"_a{2 * i + 1}")
        at = (F.col("_n") - 1) * F.lit(params["q"])
        t = at - F.floor(at)
        return F.when(t >= 0.5, b - (b - a) * (1 - t)).otherwise(a + (b - a) * t)
    if calc == "count_above_mean":
        return F.col("_n") - F.col(f"_a{column['mean', True]}")
    if calc == "count_below_mean":
        return F.col(f"_a{column['mean', False]}")
    r = float(params["r"])
    beyond = F.col("_n") - F.col(f"_a{column[r, True]}") + F.col(f"_a{column[r, False]}")
    return beyond / F.col("_n")
