"""Corpus curation and analytics expressed as Spark DataFrame plans."""
