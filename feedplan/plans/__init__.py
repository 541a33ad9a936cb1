"""Dataset definitions and end-to-end flows."""
