"""Operators for text corpora: cleaning, de-duplication, decontamination and packing."""
