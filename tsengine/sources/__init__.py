"""Sources: landed market payloads, ranking / coin-list tables, stand-in adapters."""

from tsengine.sources.catalog import lookup_ids, top_coin_ids, top_n
from tsengine.sources.market import (
    DEFAULT_METRICS, bin_step_seconds, display_zone, parse_payload, payload_to_ticks,
    read_market_chart, ticks_to_payload, time_range,
)
from tsengine.sources.tables import (
    customer_markets, events_markets, events_ticks, nation_coin_list, orders_ticks, table,
)

__all__ = [
    "DEFAULT_METRICS", "bin_step_seconds", "display_zone", "parse_payload", "payload_to_ticks",
    "read_market_chart", "ticks_to_payload", "time_range", "lookup_ids", "top_coin_ids", "top_n",
    "customer_markets", "events_markets", "events_ticks", "nation_coin_list", "orders_ticks", "table",
]
