"""Operators that turn one or more DataFrames into another."""
