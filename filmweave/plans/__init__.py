"""Whole plans, from pages or dumps to catalogue, linked table and index."""
