"""Features that read stored prefix sums at computed positions.

A window that ends at row ``t`` is the series up to ``t``, so what a stretch of it
sums to is the difference of two prefix sums of the series, whatever the window.
Prefix sums are written once a row (``operators.rank.running_sums``, no task
holds a series); a window then looks up the positions it needs:

* ``energy_ratio_by_chunks``: the edges of its segments follow from its length;
  an equi-join on ``(variable, position)`` brings the sums of squares there.  A
  position is an edge of few windows (``segments / k`` of them for the ``k``-th
  edge), so the join has no hot key.
* ``index_mass_quantile``: the first position whose sum of absolute values
  reaches a share of the window's.  These sums ascend along the series, so it is
  the number of smaller ones: a merge of sums and thresholds by range
  (``functions.ordered.threshold_ranks``).

Fixed-point input is summed and compared on unscaled integers, exactly.  A
window without mass (only zeros) gives null.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.functions.native import _Terms
from tsengine.functions.ordered import threshold_ranks
from tsengine.operators.rank import running_sums
from tsengine.operators.roll import with_positions
from tsengine.session import materialize

PREFIX = frozenset({"energy_ratio_by_chunks", "index_mass_quantile"})


def prefix_features(series: DataFrame, specs: Sequence[tuple], variable: str = "variable", order: str = "datetime",
                    value: str = "value", block_seconds: int = 7 * 86_400) -> DataFrame:
    """Long features ``variable, datetime, feature, value`` of the calculators in :data:`PREFIX`."""
    terms = _Terms(series.schema[value].dataType)
    unit = terms.unit(F.col(value))
    rows = series.select(F.col(variable).alias("_v"), F.col(order).alias("_t"), F.abs(unit).cast(terms.num_type).alias("_abs"),
                         terms.mul(unit, unit).alias("_sq"))
    rows = with_positions(rows, "_t", ["_v"], block_seconds, "_pos")
    sums = materialize(running_sums(rows, ["_v"], ["_pos"], {"_abs": "_mass", "_sq": "_energy"})
                       .select("_v", "_t", "_pos", "_mass", "_energy"))
    wide, feats = sums, []
    for m in sorted({s[1]["num_segments"] for s in specs if s[0] == "energy_ratio_by_chunks"}):
        wide = wide.join(_edges(sums, m), ["_v", "_pos"])
        # an edge at the window's start has nothing before it
        at = [F.coalesce(F.col(f"_e{m}_{k}"), F.lit(0).cast(terms.num_type)).cast("double") for k in range(m + 1)]
        feats += [(s[2], F.try_divide(at[s[1]["segment_focus"] + 1] - at[s[1]["segment_focus"]], F.col("_energy").cast("double")))
                  for s in specs if s[0] == "energy_ratio_by_chunks" and s[1]["num_segments"] == m]
    masses = [s for s in specs if s[0] == "index_mass_quantile"]
    if masses:
        wide = wide.join(_mass_places(sums, [s[1]["q"] for s in masses], terms), ["_v", "_pos"])
        feats += [(s[2], F.when(F.col("_mass") > 0, (F.col(f"_m{i}") + 1) / (F.col("_pos") + 1))) for i, s in enumerate(masses)]
    wide = wide.select("_v", "_t", *[c.cast("double").alias(f"_f{i}") for i, (_, c) in enumerate(feats)])
    long = wide.unpivot(["_v", "_t"], [f"_f{i}" for i in range(len(feats))], "_k", "value")
    names = F.create_map(*[x for i, (name, _) in enumerate(feats) for x in (F.lit(f"_f{i}"), F.lit(name))])
    return long.select(F.col("_v").alias(variable), F.col("_t").alias(order),
                       F.concat(F.col("_v"), F.lit("__"), names[F.col("_k")]).alias("feature"), "value")


def _edges(sums: DataFrame, m: int) -> DataFrame:
    """The sums of squares before the edges 0..m of every window's segments: the
    first ``n % m`` of them are one row longer than the others."""
    edge = f"_k * ((_pos + 1) div {m}) + least(_k, (_pos + 1) % {m})"
    asked = sums.selectExpr("_v", "_pos", f"explode(sequence(0, {m})) as _k").selectExpr("_v", "_pos", "_k", f"{edge} - 1 as _at")
    there = sums.selectExpr("_v", "_pos as _at", "_energy")
    found = asked.join(there, ["_v", "_at"], "left")      # edge 0 finds nothing
    return found.groupBy("_v", "_pos").agg(*[F.expr(f"max(_energy) filter (where _k = {k}) as _e{m}_{k}") for k in range(m + 1)])


def _mass_places(sums: DataFrame, shares: list[float], terms: _Terms) -> DataFrame:
    """How many positions have less than each share of the window's mass before them."""
    exact = [Decimal(str(q)) for q in shares]
    whole = 10 ** max(0, *(-q.as_tuple().exponent for q in exact))
    one = F.lit(whole).cast(terms.num_type)
    points = sums.select("_v", (F.col("_mass") * one).cast(terms.num_type).alias("_xd"))
    at = [(F.col("_mass") * F.lit(int(q * whole)).cast(terms.num_type)).cast(terms.num_type) for q in exact]
    asked = sums.select("_v", "_pos", F.explode(F.array(*[F.struct(F.lit(i).alias("_ask"), c.alias("_at")) for i, c in enumerate(at)]))
                        .alias("_w")).select("_v", "_pos", "_w._ask", "_w._at", F.lit(False).alias("_inclusive"))
    ranks = threshold_ranks(points, asked)
    return ranks.groupBy("_v", "_pos").agg(*[F.expr(f"max(_arg) filter (where _ask = {i}) as _m{i}") for i in range(len(shares))])
