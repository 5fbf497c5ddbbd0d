"""Reading and writing tables: scans, merges, sinks, retention."""
