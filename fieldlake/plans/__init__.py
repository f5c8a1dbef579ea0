"""Registered queries: each key pairs a Spark job with the SQL that checks it."""
