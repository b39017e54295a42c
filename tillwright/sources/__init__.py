"""Readers: CSV, JDBC, monthly Parquet, inline literals, SQL views."""
