"""Connected components; see :mod:`cartolex.operators.components`."""

from __future__ import annotations

from cartolex.operators.components import connected_components

__all__ = ["connected_components"]
