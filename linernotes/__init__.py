"""Music-catalogue lakehouse and property-graph queries as Spark jobs."""
