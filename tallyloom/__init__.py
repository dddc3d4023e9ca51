"""Spark-native catalog reconciliation: DataFrame in, DataFrame out."""
