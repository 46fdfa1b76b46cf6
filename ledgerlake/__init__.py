"""Ledger lake: account-ledger and price analytics as PySpark DataFrame jobs."""
