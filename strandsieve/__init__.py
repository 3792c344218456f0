"""strandsieve: a Spark-native engine for designing and auditing diagnostic k-mer panels."""

__version__ = "0.1.0"
