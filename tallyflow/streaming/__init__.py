"""tallyflow.streaming."""
