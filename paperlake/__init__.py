"""Paper-corpus lake and hybrid search, written as Spark DataFrame jobs."""
