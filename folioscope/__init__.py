"""Document-evaluation and corpus analytics as PySpark DataFrame operators."""
