"""Writers: tables, messages and micro-batch callbacks."""
