"""Training-data operators on whole corpora (documents, pages, benchmark items).

One module per operator, each with a general interface of its own; ``queries``
holds the thin registered queries and their SQL. Nothing else in the library
imports this package.
"""
