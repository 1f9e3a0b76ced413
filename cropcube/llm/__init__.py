"""Operators for large-scale training-data preparation (documents, embeddings).

Nothing outside this package imports it; ``queries.py`` registers its queries.
"""
