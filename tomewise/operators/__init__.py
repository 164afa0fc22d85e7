"""Operators on DataFrames: counting, profiles, TF-IDF, similarity, influence."""
