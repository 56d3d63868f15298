"""strata: layered (Bronze, Silver, Gold) forecast analytics as PySpark DataFrame jobs."""
