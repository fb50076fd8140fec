"""dotledger: a PySpark-native engine for mining document evidence into tables."""

__version__ = "0.1.0"
