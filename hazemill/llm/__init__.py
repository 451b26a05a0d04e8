"""Operators for preparing training data: near copies, extraction, search, secrets,
packing, sharding, tokenizing, toxicity and personal data. Nothing else in the library
imports this subpackage."""
