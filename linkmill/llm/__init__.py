"""Operators for large training-data pipelines.

Nothing outside this subpackage imports it. ``linkmill.llm.queries`` holds the
registered queries and their SQL.
"""
