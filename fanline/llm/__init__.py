"""Operators for preparing training data at scale (nothing else in fanline imports this)."""
