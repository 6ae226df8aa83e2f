"""Zonal statistics of gridded data over administrative polygons, on Spark."""
