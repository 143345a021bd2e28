"""Coin ranking and id lookup (market ranking and coin-list tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n(markets: DataFrame, n: int, by: str = "market_cap", id_col: str = "id") -> DataFrame:
    """The ``n`` largest entries by ``by`` with a 1-based ``rank``; ties go to the smaller id.

    ``orderBy + limit`` plans as TakeOrderedAndProject: every task keeps its
    own top ``n`` and only those reach the final merge.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    top = markets.orderBy(F.col(by).desc_nulls_last(), F.col(id_col).asc()).limit(n)
    return top.select(id_col, by, F.row_number().over(
        _rank_window(by, id_col)).cast("bigint").alias("rank"))


def _rank_window(by: str, id_col: str):
    from pyspark.sql import Window
    # Over at most n rows (after the limit), so one partition is fine.
    return Window.orderBy(F.col(by).desc_nulls_last(), F.col(id_col).asc())


def top_coin_ids(markets: DataFrame, n: int, by: str = "market_cap", id_col: str = "id") -> list[str]:
    """Ranked coin ids as a driver list (at most ``n`` values, the size of the request)."""
    rows = top_n(markets, n, by, id_col).orderBy("rank").select(id_col).collect()
    return [r[0] for r in rows]


def lookup_ids(coin_list: DataFrame, request: DataFrame, name_col: str = "name",
               id_col: str = "id", pos_col: str = "pos", validate: bool = True) -> DataFrame:
    """Map requested names to ids, keeping request order and duplicates.

    ``request`` holds ``(pos, name)``; the result is ``(pos, name, id)`` ordered
    by ``pos``.  A name that is missing from the list raises (``validate``),
    found with an anti join.  A name listed twice yields both ids.
    """
    ids = coin_list.select(F.col(name_col).alias("name"), F.col(id_col).alias("id"))
    req = request.select(F.col(pos_col).alias("pos"), F.col(name_col).alias("name"))
    if validate:
        missing = req.join(ids, "name", "left_anti").select("name").limit(5).collect()
        if missing:
            raise KeyError(f"names not in the coin list: {[r[0] for r in missing]}")
    return req.join(ids, "name", "inner").select("pos", "name", "id").orderBy("pos", "id")
