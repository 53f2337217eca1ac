"""Catalogue extraction, entity linking and ranked search as Spark plans."""
