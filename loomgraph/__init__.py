"""A Spark-native engine for document graphs: extract, classify, link, rank, publish."""
