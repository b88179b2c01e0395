"""Plans: the warehouse build, the business questions and validated ingestion."""
