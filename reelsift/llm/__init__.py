"""Training-data operators: one module per operator, queries and SQL in ``registry.py``.

Nothing outside this folder (but ``corpus_pipeline.py`` and the guarded hook in ``__spark_entry__.py``) imports it.
"""
