"""Rating analytics and recommendation on Spark DataFrames."""
