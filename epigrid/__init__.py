"""Spatial disease-surveillance analytics as Spark DataFrame operators."""
