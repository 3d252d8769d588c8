"""Contact audiences on Spark: base population, suppression and keep rules, enrichment, export."""
