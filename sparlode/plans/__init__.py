"""Rewrites and accelerators that are optional: results never depend on them."""
