"""Fixed query parameters of the registered queries (shared by Spark and oracle SQL)."""

from ..functions.time import Grid, duration_ns, to_epoch_ns

# Evaluation grid over the events month.
GRID_START = "2024-01-01 00:00:00"
GRID_END = "2024-01-31 00:00:00"
GRID_STEP = "1h"
RATE_RANGE = "1d"
LOOKBACK = "6h"
TOPK = 3
LOG_RANGE = "6h"

GRID = Grid.of(GRID_START, GRID_END, GRID_STEP)
START_NS = GRID.start_ns
END_NS = GRID.end_ns
STEP_NS = GRID.step_ns
RANGE_NS = duration_ns(RATE_RANGE)
LOOKBACK_NS = duration_ns(LOOKBACK)
LOG_RANGE_NS = duration_ns(LOG_RANGE)
N_POINTS = GRID.n_points
MID_NS = to_epoch_ns("2024-01-15 12:00:00")
