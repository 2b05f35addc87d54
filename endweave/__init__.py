"""endweave: a Spark-native engine for transcript-end analytics."""
