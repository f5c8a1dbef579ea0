"""Sinks: hot and cold stores, ledgers, upserts, data-set files."""
