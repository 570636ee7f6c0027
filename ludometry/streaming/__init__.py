"""Picking up new raw files."""
