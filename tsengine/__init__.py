"""tsengine: Spark-native time-series feature engineering and forecasting.

The pipeline, stage by stage (every stage is a lazy DataFrame transformation
unless stated otherwise):

    landed market payloads / tables      -> tsengine.sources
    resample to bins, align coins, melt  -> tsengine.operators.resample / align
    expanding windows, feature families  -> tsengine.operators.roll, tsengine.functions
    targets, imputation, FDR selection   -> tsengine.operators.target / impute / select
    time splits, folds, tree models      -> tsengine.operators.split / search
    metrics, importances                 -> tsengine.operators.evaluate
    end-to-end compositions              -> tsengine.plans
"""

from tsengine.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
