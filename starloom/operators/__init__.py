"""Operators on photon, pointing, cube and map tables: DataFrame in, DataFrame out."""
