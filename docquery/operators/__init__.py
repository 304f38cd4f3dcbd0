"""What is done with a collection: reads, aggregates, projections and patches."""
