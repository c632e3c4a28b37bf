"""Compositions: the mart layer, the metric layer and data contracts."""
