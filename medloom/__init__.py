"""Clinical data standardization, quality metrics and hospital measures as Spark DataFrame jobs."""
