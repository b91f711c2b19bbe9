"""Whole jobs built from the operators: summaries, facts, cell catch, stock status, documents, extents."""
