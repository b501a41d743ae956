"""Walk-forward forecasting features, folds, volatility and model selection on Spark."""
