"""Operators for building training data at corpus scale: filtering, deduplication, mixing, scoring."""
