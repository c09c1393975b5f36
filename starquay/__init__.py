"""Spark jobs that turn raw arrival, temperature, demographic and code-list
files into a checked star schema in Parquet, and answer questions on it."""
