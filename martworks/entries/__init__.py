"""Registered queries on the star-schema test tables, each with the SQL that states its result independently."""

from martworks.entries import checks, marts, transforms, upkeep

MODULES = (marts, checks, transforms, upkeep)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
