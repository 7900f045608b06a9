"""Operators of a pipeline that prepares training data; nothing else in the package needs them."""
