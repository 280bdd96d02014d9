"""A PySpark-native engine for filtering, aggregating and faceting semi-structured tables.

Everything is a DataFrame plan; Catalyst and Tungsten choose how it runs.
"""

from .operators.aggregates import aggregate, statistics
from .operators.facets import facet
from .operators.joins import as_of_join, interval_join
from .plans.session import configure, session
from .sources.storage import compact, query, read_index, update_by_key, write_index

__all__ = ["aggregate", "as_of_join", "compact", "configure", "facet", "interval_join", "query", "read_index", "session", "statistics", "update_by_key", "write_index"]
