"""cohortlens: similar-case analytics as Spark DataFrame jobs."""
