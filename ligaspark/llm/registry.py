"""What ``__spark_entry__`` adds when this subpackage is there."""

from .oracles import ORACLES
from .queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
