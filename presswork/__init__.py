"""Presswork: labelled news-content datasets built with Spark DataFrames."""
