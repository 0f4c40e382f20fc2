"""Dimensions, measures, insights and the layered daily run."""
