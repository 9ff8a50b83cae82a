"""Operators over observation DataFrames: pivots, gates, comparisons, profiles."""
