"""tallyflow.functions."""
