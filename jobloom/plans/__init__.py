"""Whole runs: the stages in their order, and the tables that queries are run on."""
