"""Operators for preparing training data at scale; see ``queries`` for what is registered."""
