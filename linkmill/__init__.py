"""Record linkage of contacts with a company registry, and data-pipeline operators, on Spark."""
