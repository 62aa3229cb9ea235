"""Operators on cubes, patches, channels and graphs; each takes and returns DataFrames."""
