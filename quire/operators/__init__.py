"""Operators over DataFrames: parts, ordinals, embedding, quantisers, neighbours, hydration."""
