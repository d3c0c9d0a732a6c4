"""webloom: a PySpark-native engine for building and analysing text corpora from web crawls."""

__version__ = "0.1.0"
