"""Cell-tower analytics as composable PySpark DataFrame operators."""
from mastgrid.functions.derive import (
    with_operator,
    with_operator_code,
    with_operator_color,
    with_region,
    with_tech_color,
    with_timestamps,
    with_tower_id,
    with_year,
)
from mastgrid.operators import *  # noqa: F401,F403
from mastgrid.operators import __all__ as _operators
from mastgrid.sources.sinks import save_clean, write_result
from mastgrid.sources.towers import conform_towers, read_towers, tower_lines

__all__ = [
    *_operators,
    "conform_towers",
    "read_towers",
    "save_clean",
    "tower_lines",
    "with_operator",
    "with_operator_code",
    "with_operator_color",
    "with_region",
    "with_tech_color",
    "with_timestamps",
    "with_tower_id",
    "with_year",
    "write_result",
]
