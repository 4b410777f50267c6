"""Payment transaction scoring and reporting on Spark DataFrames."""
