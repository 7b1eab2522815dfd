"""Operators on the texts of a training corpus; nothing outside this folder imports them."""
