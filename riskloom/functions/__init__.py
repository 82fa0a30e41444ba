"""Column -> Column rules, all native Spark expressions."""
