"""Reservation analytics written for Spark DataFrames, SQL, streams and ML."""
