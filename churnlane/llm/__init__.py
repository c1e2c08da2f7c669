"""Training-data operators: dedup, decontamination, language ID, mixing, sharding.

Nothing outside this subpackage imports it, so it can be removed whole.
"""
