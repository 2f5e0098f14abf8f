"""quire: bibliographic analytics and training-data preparation on Spark DataFrames."""
