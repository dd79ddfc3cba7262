"""Spark-native curation, training preparation and evaluation of Q&A corpora."""
