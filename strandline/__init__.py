"""Genomic interval and signal analysis as PySpark DataFrame transformations."""
