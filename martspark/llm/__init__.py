"""Operators of a large-scale training-data pipeline; nothing else in the library imports them."""

from .oracles import ORACLES  # noqa: F401
from .queries import QUERIES  # noqa: F401
