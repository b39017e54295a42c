"""Table-to-table operators: cleaning, deduplication, key checks, quality checks, risk flags."""
