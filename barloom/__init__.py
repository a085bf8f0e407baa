"""barloom: a Spark-native engine that weaves trade ticks into bars, features and datasets."""
