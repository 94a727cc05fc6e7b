"""A contract-ledger analytics engine on PySpark."""
