"""Readers and dimension seeds."""
