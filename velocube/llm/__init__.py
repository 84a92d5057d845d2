"""Training-data operators: quality, decontamination, search, token files, secrets, near-dedup, tokenizers, LM scores.

Each module holds one operator with its own interface; ``queries`` derives the registered queries from them.
"""
