"""Documents to a validated knowledge graph, as Spark DataFrame jobs."""
