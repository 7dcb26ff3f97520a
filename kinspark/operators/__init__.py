"""Relational operators: blocking, scoring, assignment, evaluation, validation."""
