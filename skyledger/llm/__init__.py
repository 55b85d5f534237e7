"""Training-data operators (`llm`): ten large-scale text operators and their queries.

Nothing else in the library imports this package; `__spark_entry__.py` adds its
queries only if it can be imported.
"""
