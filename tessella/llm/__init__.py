"""Operators for training-data pipelines.

Nothing outside this folder imports it. Each module holds one operator; its
query is registered by :func:`tessella.llm.registry.queries`.
"""
