"""Monthly-snapshot analytics and credit-risk model monitoring on Spark."""

__version__ = "0.1.0"
