"""lexmill: a Spark-first engine for legal-text corpora."""
