"""Training-data operators: one module per operator, plus their registered queries.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries only when it is present.
"""
