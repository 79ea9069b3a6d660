"""functions of terrawave."""
