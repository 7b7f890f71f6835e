"""Operators on pass DataFrames; batch and live alike unless a docstring says otherwise."""
