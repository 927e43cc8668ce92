"""millrace: Spark jobs that clean, measure and export training data for code models."""
