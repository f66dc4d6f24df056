"""lexquarry: a Spark-native engine for versioned corpora of structured legal documents."""

__version__ = "0.1.0"
