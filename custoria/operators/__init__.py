"""Cleaning, features, scores, validation, exploration, preparation, balancing and models."""
