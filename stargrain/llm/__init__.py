"""Operators of a training-data pipeline; each module's docstring states its method and its edge cases."""
