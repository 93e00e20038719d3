"""Spark-native data curation: balanced selection, clustering, sampling, tiling and export.

Everything here takes and returns Spark DataFrames; plans are declared with the DataFrame API and
left to Catalyst, and Python runs only where an operator is sequential or works on rasters.
"""
