"""The operators as queries on the driver tables, each with an equivalent SQL text.

The tables stand in for the real files: orders are properties (``o_orderkey`` the unit, ``o_custkey`` the building),
line items are loans or ratings, customers carry the flood index, nations are councils. Every query reads whole
tables; missing matches are those the tables themselves have (orders without line items, documents without labels).
"""

from __future__ import annotations

from catalogue import books, councils, days, exposure, files, jobs, layers, merges, quality, scores

MODULES = (merges, exposure, scores, layers, books, quality, councils, files, jobs, days)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: text for module in MODULES for name, text in module.SQL.items()}
