"""Operators for preparing training text: dedup, decontamination, scoring, packing, archives."""
