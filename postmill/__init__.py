"""Job-posting warehouse as Spark jobs: cleaning, skill extraction, keys, loads, checks and marts."""
