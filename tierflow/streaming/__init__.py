"""Continuous queries over the same operators."""
