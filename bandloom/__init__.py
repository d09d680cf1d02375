"""bandloom: multi-band raster analytics expressed as Spark DataFrames."""
