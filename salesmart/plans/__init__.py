"""Whole jobs: cleaning, entity derivation, views, the published warehouse and the daily load."""
