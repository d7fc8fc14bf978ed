"""All registered queries and the SQL they are checked against."""

from orevein.plans import basket_queries, cluster_queries, text_queries, tree_queries

_FAMILIES = (basket_queries, text_queries, cluster_queries, tree_queries)

QUERIES = {name: query for family in _FAMILIES for name, query in family.QUERIES.items()}
ORACLES = {name: sql for family in _FAMILIES for name, sql in family.ORACLES.items()}
