"""Purchase analytics on Spark DataFrames: clean, describe, cluster, score and profile customers."""
