"""Whole jobs: analyse a table, compare classifiers, train and score."""
