"""Compositions of operators, from raw observations to forecasts."""
