"""Operators for training data: quality, fixity, tokens, toxicity, duplicates, shards, decontamination."""
