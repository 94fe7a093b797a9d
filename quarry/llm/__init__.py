"""Training-data operators: filters, near-duplicate joins, mixing, scoring, sharding, PII.

Nothing outside this package imports it; ``__spark_entry__.py`` registers its
queries when the package is there.
"""
