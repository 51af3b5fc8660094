"""Registered queries over the driver tables."""

from . import pairsets, relations, showcase, taskset  # noqa: F401
from .tables import ORACLES, QUERIES  # noqa: F401
