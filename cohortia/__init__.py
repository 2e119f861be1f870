"""Audience labelling, training-set assembly, scoring and reporting on Spark DataFrames."""
