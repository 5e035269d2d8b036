"""tidemark: Spark-native time-series intake, versioning and projection."""
