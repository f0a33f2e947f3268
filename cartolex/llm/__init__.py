"""Training-data operators: dedup, language, quality, tokens, mixing, search, URL rules.

Nothing outside this subpackage imports it; its queries are in :mod:`cartolex.llm.queries`.
"""
