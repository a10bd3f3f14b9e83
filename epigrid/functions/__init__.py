"""Column functions: planar distance, geohash cells, rings and colours."""
