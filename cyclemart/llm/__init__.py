"""Operators for preparing training text: scoring, counting, packing, de-duplication, archives, extraction."""
