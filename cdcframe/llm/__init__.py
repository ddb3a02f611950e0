"""Operators for preparing the training text of language models. Nothing else in the library imports this."""
