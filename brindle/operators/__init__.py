from brindle.operators.asof import asof_join
from brindle.operators.bounded import bounded, preview
from brindle.operators.intervals import interval_join
from brindle.operators.report import column_list, missing_columns_message, row_count, schema_report
from brindle.operators.sessions import rolling, sessions
from brindle.operators.sketches import estimates, merged_sketches, period_sketches, period_values
from brindle.operators.subtotals import cube_sets, rollup_sets, subtotals

__all__ = ["asof_join", "bounded", "column_list", "cube_sets", "estimates", "interval_join", "merged_sketches", "missing_columns_message", "period_sketches", "period_values", "preview", "rolling", "rollup_sets", "row_count", "schema_report", "sessions", "subtotals"]
