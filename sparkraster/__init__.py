"""Raster and scene-metadata analytics expressed as Spark DataFrame transformations."""
