"""Part of cairnwork."""
