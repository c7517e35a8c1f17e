"""Operators for preparing text corpora, one module per operator, with their queries.

`QUERIES` and `ORACLES` in `llm.registry` hold the registered queries. Nothing outside this
subpackage imports it, except the driver entry and `corpus_pipeline.py`.
"""
