"""Slices, settings, resume rules and the three stages of a run."""
