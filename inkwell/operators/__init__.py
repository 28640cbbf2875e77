"""Operators of the curation engine."""
