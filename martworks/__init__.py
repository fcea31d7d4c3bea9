"""Star-schema marts, reusable transforms and data-quality checks as plain PySpark DataFrame functions."""
