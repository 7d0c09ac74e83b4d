"""MLlib pipelines over the wide feature matrix."""
