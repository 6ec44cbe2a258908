"""Column builders: sky geometry, binning, guarded arithmetic."""
