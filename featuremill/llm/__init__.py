"""Operators for preparing language-model training data, on Spark.

One module per operator; ``queries`` registers the ``opN_*`` queries. Nothing outside this
folder (and ``corpus_pipeline.py`` at the repository top) imports it.
"""
