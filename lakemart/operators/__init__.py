"""Reusable DataFrame -> DataFrame operators."""
