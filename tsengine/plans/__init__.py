"""End-to-end compositions of the operators (extraction, selection, forecasting)."""
