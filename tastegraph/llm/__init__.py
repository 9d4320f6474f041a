"""Training-data operators: filters, near-duplicate joins, models, mixing, tokens.

Nothing outside this subpackage imports it; ``catalog`` lists its queries.
"""
