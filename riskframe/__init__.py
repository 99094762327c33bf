"""riskframe: credit-risk analytics on loan-level tables, as Spark jobs."""

__version__ = "0.1.0"
