"""Lifecycle of large time-partitioned tables as Spark jobs: discover, load, check and clean up units."""
