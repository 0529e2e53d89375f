"""Reference SQL for the registered queries, written for DuckDB.

Fragments are named relations; ``compose`` puts the ones a query needs in front of it
as common table expressions.
"""

from oracle.compose import compose

__all__ = ["compose"]
