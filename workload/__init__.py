"""The registered queries: every operator over the whole given tables."""
