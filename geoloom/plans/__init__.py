"""Layers and the feature query that turns request parameters into one DataFrame."""
