from . import families, operators, tables, text  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
