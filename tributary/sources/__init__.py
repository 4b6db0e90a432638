"""Reading and writing: CSV and Parquet, bucketed tables and sort layouts,
file sizes, and per-period snapshot writers."""
