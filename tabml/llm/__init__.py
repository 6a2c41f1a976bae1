"""Operators for preparing training data: one module per operator, the shared
helpers in ``common``, ``components`` and ``pretokens``, the registered queries
in ``queries`` and their DuckDB SQL in ``oracles``.

Nothing outside this sub-package (and ``corpus_pipeline.py``) imports it.
"""
