"""The scalar function vocabulary."""
