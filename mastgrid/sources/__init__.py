from mastgrid.sources.lineitem import towers_from_lineitem
from mastgrid.sources.sinks import save_clean, write_result
from mastgrid.sources.towers import conform_towers, read_towers, tower_lines

__all__ = [
    "conform_towers", "read_towers", "save_clean", "tower_lines", "towers_from_lineitem",
    "write_result",
]
