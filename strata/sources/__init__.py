"""Sources: incremental JSON ingest, schema store, file scans, driver-table adapter, generator."""
