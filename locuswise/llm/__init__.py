"""Operators of a training-data pipeline: tokens, language, copies, packing, scoring, privacy, quality, URLs."""
