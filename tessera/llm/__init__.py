"""Operators for preparing language-model training data.

Each operator lives in a module of its own, takes DataFrames and returns
DataFrames; ``queries`` holds the thin ``opN_<name>`` queries over them.
"""
