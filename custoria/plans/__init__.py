"""Whole stages composed from the operators."""
