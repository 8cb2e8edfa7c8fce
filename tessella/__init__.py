"""Point, polygon, voxel and region-tree analytics as PySpark DataFrame functions."""
