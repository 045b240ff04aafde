"""Inputs: text lines and their CSV dialects, lookup tables, the star-schema adapter."""
