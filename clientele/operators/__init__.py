"""Relational and model operators; each is a function from DataFrame to DataFrame."""
