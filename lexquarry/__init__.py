"""Spark-native text-corpus, retrieval and knowledge-graph analytics."""
