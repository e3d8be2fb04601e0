"""Whole reports built from the operators, and the star schema of the test tables."""
