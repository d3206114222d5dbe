"""Training-data operators: extraction, quality, tokens, dedup, search, mixing.

Nothing outside this sub-package imports it; ``__spark_entry__`` adds its
queries when it is present.
"""
