"""Table-level operators and composed plans for school data integration,
segmentation and impact analysis, built on Spark DataFrames and pyspark.ml."""
