"""millrace: a Spark-native engine for building and evaluating text-correction corpora."""
