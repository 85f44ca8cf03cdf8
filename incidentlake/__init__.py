"""Incident analytics on Spark: layered refinement, exploration, density and learning."""

__version__ = "0.1.0"
