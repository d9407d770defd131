"""Sources (source schemas, seed, fixture adapters, scans) and sinks."""
