"""Operators of a training-data pipeline over ``documents``, ``pages``,
``benchmark`` and ``conversations`` tables.  Nothing else in the library
imports this subpackage."""
