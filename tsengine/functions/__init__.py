"""Feature calculators: settings and names, Spark-native running features,
per-window array calculators, and numeric helpers."""

from tsengine.functions.settings import (
    COMPREHENSIVE, EFFICIENT, MINIMAL, feature_name, feature_specs, resolve,
)

__all__ = ["COMPREHENSIVE", "EFFICIENT", "MINIMAL", "feature_name", "feature_specs", "resolve"]
