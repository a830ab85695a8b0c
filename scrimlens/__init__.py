"""Match and event analytics on Spark: curation jobs, comparison reports and streams."""
