"""Training-data operators: one module per operator, each usable on any DataFrame.

``queries.py`` applies each of them to its whole test table under the name ``opN_<name>``.
Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
