"""Sources: tables, domain views, files, streams, relational stores, brokers."""
