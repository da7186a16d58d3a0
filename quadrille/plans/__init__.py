"""Graph patterns and rules as DataFrame plans."""
