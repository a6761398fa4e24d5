"""Operators for preparing training text: scoring, scanning, tokenising, formatting and duplicate removal."""
