"""Operators for preparing language-model training data, one module per operator.

Nothing else in the package imports this sub-package.
"""
