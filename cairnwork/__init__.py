"""cairnwork: record curation, matching and serving queries as Spark plans."""
