"""Data sets and jobs composed from the operators."""
