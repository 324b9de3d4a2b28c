"""Operators for cleaning training text at scale; nothing outside this folder imports them."""
