"""Transaction-ledger analytics as PySpark DataFrame jobs."""
