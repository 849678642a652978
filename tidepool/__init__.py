"""Tidepool: DataFrame-in, DataFrame-out analytics operators for PySpark."""
