"""Registered queries: inputs, Spark plans and their SQL counterparts."""
