"""Quality gauges for a claims-processing pipeline, as Spark DataFrame operators."""
