"""Operators for preparing training corpora: search, packing, scoring, filtering, deduplication, mixing, output."""
