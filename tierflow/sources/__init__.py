"""Readers: message sources, tables, record files, named relations."""
