"""lexmill: a Spark-native engine that builds, merges, ranks and evaluates lexicons."""
