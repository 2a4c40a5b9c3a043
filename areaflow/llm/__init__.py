"""Operators for preparing training text: quality, toxicity, near copies, mixing, packing, archives, models."""
