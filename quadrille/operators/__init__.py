"""Operators on quads: lifting, rewriting, resolution, publishing, derived statements."""
