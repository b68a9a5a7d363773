"""Relational operators: grouping of copies, consensus, calibration, decisions, evaluation."""
