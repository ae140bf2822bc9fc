"""Operators for preparing training data: filtering, search, redaction, sharding, packing, mixing."""
