"""Operators of a training-data pipeline over a table of documents.

Each module holds one operator with a general interface. ``queries`` applies them to the whole tables and
derives the columns of the query contracts; nothing outside this package imports it.
"""
