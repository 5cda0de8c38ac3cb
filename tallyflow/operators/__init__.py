"""tallyflow.operators."""
