"""General-ledger analytics on Spark DataFrames.

Layers: ``sources`` read and write files, ``functions`` are column expressions,
``operators`` are table-shaped building blocks that take column names, ``plans``
assemble them into the ledger models, ``checks`` holds the registered queries.
"""
