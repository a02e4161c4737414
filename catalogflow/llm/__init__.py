"""Operators for the preparation of training text: each works on whole tables and whole texts."""
