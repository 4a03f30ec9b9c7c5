"""Registered queries with the SQL each is checked against.

Each module holds functions `name(spark, sf_dir)` under QUERIES and SQL texts under SQL. The
queries map the event logs onto the given tables; thresholds are larger than the operators' defaults
where the tables are sparse.
"""

from tidemark.plans import market, orders, parsing, security, sensors, streams, traffic, wordcounts

_MODULES = (traffic, market, security, orders, sensors, wordcounts, parsing, streams)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: text for module in _MODULES for name, text in module.SQL.items()}
