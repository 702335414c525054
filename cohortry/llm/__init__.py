"""Operators that prepare text for model training, each a function from DataFrame to DataFrame."""
