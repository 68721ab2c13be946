"""credence: a Spark-native feature, scoring and data-quality engine for
tabular decision data (loan applications)."""

__version__ = "0.1.0"
