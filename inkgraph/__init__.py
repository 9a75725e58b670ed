"""Text and graph analytics as Spark jobs: DataFrames in, DataFrames out."""
