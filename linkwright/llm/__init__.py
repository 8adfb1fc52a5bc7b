"""Operators for training-data pipelines: fixity, sharding, near-dedup, chat, scoring, decontamination, tokens, quality."""
