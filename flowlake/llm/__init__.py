"""Operators of a training-data pipeline, one module per operator.

mixing, url_rules, simhash, quality, chat, language_model, language_id, bpe,
licenses, vectors; ``components`` and ``common`` are shared helpers and
``queries`` holds the registered queries with their DuckDB SQL.  Nothing else
in the library imports this subpackage.
"""
