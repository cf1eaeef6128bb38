"""Relational operators, each DataFrame(s) in and DataFrame out."""
