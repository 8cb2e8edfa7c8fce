"""Corpus operators: extraction, sharding, packing, scoring, filtering, deduplication, redaction.

Every module holds one operator with a general interface and the thin query
``opN_...`` that applies it to a whole table. Nothing outside this subpackage
imports it.
"""
