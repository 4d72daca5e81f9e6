"""Streams against static tables."""
