"""All queries of this package, and their SQL where SQL can express them."""

from martworks.llm import native_queries, repair_queries, text_queries

MODULES = (native_queries, text_queries, repair_queries)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
