"""Operators for preparing training text: one module per operator.

Nothing else in the library imports this subpackage.  ``queries.QUERIES`` and
``queries.ORACLE_SQL`` are what ``__spark_entry__.py`` registers.
"""
