"""tidemark: warehouse-pipeline data jobs as plain Spark DataFrame functions."""
