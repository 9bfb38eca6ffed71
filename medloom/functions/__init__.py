"""Column expressions. Everything here is built from Spark's own functions; there are no UDFs."""
