"""Loads of the three layers and one whole run, each with a fixed number of Spark actions."""
