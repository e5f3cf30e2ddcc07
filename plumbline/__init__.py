"""plumbline: a medallion lakehouse with data-trust checks, written as Spark DataFrame jobs."""
