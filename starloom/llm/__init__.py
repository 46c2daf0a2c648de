"""Operators of a training-data pipeline: mixing, scoring, deduplication, language and quality
models, WARC archives and byte-level BPE. Nothing else in the library imports this package; its
queries are in ``starloom.llm.queries``.
"""
