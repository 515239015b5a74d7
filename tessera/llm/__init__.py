"""Training-data pipeline operators (sharding, tokens, PII, toxicity, dedup, packing, ...).

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries
only when it can be imported.
"""
