"""plumbline: a Spark-native engine for pairwise human-preference evaluation data."""
