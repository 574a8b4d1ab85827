"""Reusable DataFrame operators the facts and marts are written with."""
