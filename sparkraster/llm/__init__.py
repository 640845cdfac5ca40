"""Training-data operators over document, page and embedding tables.

Nothing outside this subpackage imports it; ``queries`` holds the registered
queries and their SQL.
"""
