"""Training-data operators: ten numbered operators and their registered queries.

Nothing else in the library imports this subpackage.  `queries` maps the names
of `__spark_entry__.py` to callables; every operator module keeps its own
general interface and is used by the queries and by `corpus_pipeline.py`.
"""
