"""Operators for preparing language-model training data (self-contained;
nothing else in the library imports this subpackage)."""
