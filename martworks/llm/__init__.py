"""Operators for training-data pipelines, one module each. Nothing else in the library imports this package.

Common rules: a null or empty text is a text without words; input columns with names that an operator uses itself do not
disturb it; where a docstring says nothing else, rows are kept as often as they came."""
