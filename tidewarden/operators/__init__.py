"""Operators over observation tables."""
