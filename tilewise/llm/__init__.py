"""Corpus-preparation operators: filtering, deduplication, decontamination, tokenisation and export.

Nothing outside this subpackage imports it. Every operator takes and returns
DataFrames; the thin ``opN_*`` queries in :mod:`tilewise.llm.queries` derive their
digest columns from the operators' results.
"""
