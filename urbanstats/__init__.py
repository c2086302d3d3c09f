"""Everyday analytics on city open data, as functions from DataFrame to DataFrame."""
