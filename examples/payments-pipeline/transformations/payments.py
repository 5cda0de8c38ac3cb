"""Declares bronze, silver, gold and the dimensions for the pipeline CLI.

``PAYMENTS_RAW_ROOT`` names the landing root (GZIP NDJSON by delivery hour).
"""

import os

from pyspark.sql import SparkSession

from tallyflow.plans.declarative import declare

declare(SparkSession.active(), raw_root=os.environ["PAYMENTS_RAW_ROOT"])
