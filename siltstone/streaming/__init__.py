"""The incremental load, driven by a file stream."""
