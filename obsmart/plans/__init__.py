"""Staging relations, facts, verdict marts and serving queries."""
