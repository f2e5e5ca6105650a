"""Opinion-corpus analytics as Spark jobs: cleaning, dedup, enrichment, layers, datasets, monitoring."""
