"""Highway-toll analytics as PySpark DataFrame operators."""
