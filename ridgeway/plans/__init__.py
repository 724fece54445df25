"""Whole runs: the experiment plan, its presets, and the census table they were made for."""
