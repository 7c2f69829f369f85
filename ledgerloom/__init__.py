"""ledgerloom: PySpark operators for financial-risk reporting and reconciliation."""
