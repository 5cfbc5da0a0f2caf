"""foliant: document-digitisation analytics as PySpark DataFrame operators."""
