"""Connected components, as the library has them."""

from terrawave.operators.graph import components

__all__ = ["components"]
