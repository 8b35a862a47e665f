"""docaudit: Spark-native auditing, scoring and curation of long text reports."""

__version__ = "0.1.0"
