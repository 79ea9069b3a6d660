"""sources of terrawave."""
