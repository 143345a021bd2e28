"""DataFrame operators: resampling, alignment and reshaping, rolling windows,
targets, imputation, feature selection, splits, model search, evaluation."""
