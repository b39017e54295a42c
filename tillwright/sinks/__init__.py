"""Writers: CSV and Parquet table sets, JDBC loads, monthly store, dated backup."""
