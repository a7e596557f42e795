"""Training-data operators: counting, deduplication, filtering, mixing, sharding and search.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
