"""Sinks and materialisations."""
