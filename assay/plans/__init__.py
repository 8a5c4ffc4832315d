"""Whole jobs put together from operators: cleaning, features, checks and models."""
