"""Whole jobs out of the operators, and the registered queries."""
