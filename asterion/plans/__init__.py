"""Whole jobs: several operators in one lazy plan."""
