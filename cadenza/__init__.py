"""cadenza: Spark-native track enrichment, cleaning and scoring."""

__version__ = "0.1.0"
