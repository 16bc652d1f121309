"""Operators for preparing large text corpora: mixing, deduplication, scanning, scoring, packing."""
