"""Whole-table loads composed from the operators."""
