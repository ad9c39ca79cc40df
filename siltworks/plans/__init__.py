"""Whole plans: the command line and the contract queries."""
