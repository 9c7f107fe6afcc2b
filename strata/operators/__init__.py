"""Relational operators of the pipeline: flatten (silver), validate (quality), aggregate (gold)."""
