"""operators of terrawave."""
