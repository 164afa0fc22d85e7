"""Whole jobs, and the two decisions they share: storing and broadcasting."""
