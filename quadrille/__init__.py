"""quadrille: a PySpark-native engine for statement graphs.

Statements are rows of a quads DataFrame; lifting, pattern matching, entity
resolution and publishing are DataFrame-to-DataFrame functions.
"""

__version__ = "0.1.0"
