"""Data-engineering operators on the public PySpark DataFrame, SQL, ML and streaming APIs."""
