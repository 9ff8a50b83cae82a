"""Training-data operators: near and exact dedup, tokens, licences, toxicity, PII, packing.

Nothing outside this subpackage imports it.
"""
