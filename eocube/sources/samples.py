"""Two sample fields: circles of a pivot irrigation, as polygons of 64 sides."""

from __future__ import annotations

import math

from ..functions.geometry import Geometry

EARTH = 6371008.8  # fixed value: mean radius in metres


def circle(lon: float, lat: float, metres: float, sides: int = 64) -> Geometry:
    """A circle on the sphere, from its northmost point westwards."""
    up = math.degrees(metres / EARTH)
    across = up / math.cos(math.radians(lat))
    turn = [2 * math.pi * i / sides for i in range(sides)]
    return Geometry("Polygon", (tuple((lon - across * math.sin(t), lat + up * math.cos(t)) for t in turn),))


def load_pivot() -> Geometry:
    return circle(-98.25, 40.5, 400.0)


def load_pivot_corumba() -> Geometry:
    return circle(-47.75, -17.25, 350.0)
