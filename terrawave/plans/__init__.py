"""plans of terrawave."""
