"""Operators put together: building history, training models, scoring requests."""
