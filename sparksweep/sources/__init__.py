"""Sources: format-routed reads (with an Arrow IPC data source), log lines, source URIs and runtime catalog files."""
