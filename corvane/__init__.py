"""A PySpark-native engine for text corpora: cleaning, chunking, lexical and vector retrieval, and evaluation."""
