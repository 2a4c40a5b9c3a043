"""Operators on any DataFrame: standardising, spatial join, aggregates, quality, coverage."""
