"""tallyflow.plans: the medallion graph wired from the operators."""
