"""millrace: data-pipeline and analytics operators for PySpark DataFrames."""
