"""tallyflow.sources."""
