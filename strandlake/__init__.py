"""Genomics, sequencing-quality and clinical-feature analytics on Spark DataFrames."""
