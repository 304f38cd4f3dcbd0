"""Collections of JSON documents on Spark: query-by-example filters compiled to Catalyst columns."""
