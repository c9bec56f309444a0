"""Training-data operators: search, dedup, tokenization, language and quality models,
extraction and mixing over the corpus tables.

Nothing outside this folder imports it. Each module holds one operator with its own
interface; ``queries.py`` holds the thin registered queries and their SQL.
"""
