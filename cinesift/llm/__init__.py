"""Training-data operators: one module per operator, queries in :mod:`.queries`.

Nothing else in the library imports this package; removing it (with ``tests/llm`` and
``corpus_pipeline.py``) leaves the ratings analytics untouched.
"""
