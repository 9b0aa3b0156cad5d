"""Operators for preparing large training corpora (each module states its contract)."""
