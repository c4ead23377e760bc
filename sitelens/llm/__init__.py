"""Operators for preparing training data at scale; see each module's docstring."""
