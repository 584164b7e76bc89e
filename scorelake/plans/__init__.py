"""Batch plans, table generations and serving."""
