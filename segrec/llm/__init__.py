"""Training-data operators: chat formatting, dedup, quality, tokens, decontamination, WARC, sharding.

Nothing outside this subpackage imports it. ``queries.py`` holds the registered queries and
their SQL; ``corpus_pipeline.py`` at the repository top chains five of the operators.
"""
