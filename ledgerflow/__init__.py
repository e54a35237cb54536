"""ledgerflow: transaction analytics and dependable incremental loads on Spark."""

__version__ = "0.1.0"
