"""Batch operators of the recommender, as DataFrame plans."""
