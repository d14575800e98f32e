"""Whole jobs: build, audit and validate a feed."""
