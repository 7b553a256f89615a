"""Reusable plan shapes: skew-proof running aggregates, as-of lookups and caps per group."""
