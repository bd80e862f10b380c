"""Retail-banking analytics on Spark: layered tables, quality rules, ledger operators, credit scoring."""
