"""Record reconciliation and evidence analytics as PySpark DataFrame operators."""
