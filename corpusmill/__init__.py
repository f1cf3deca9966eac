"""corpusmill: a PySpark-native engine that builds and audits large text corpora."""

__version__ = "0.1.0"
