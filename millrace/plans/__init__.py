"""Compositions of operators that answer whole questions."""
