from paneflow.operators.lateness import (
    ALLOWED,
    LATE,
    ON_TIME,
    accepted_rows,
    late_count,
    late_rows,
    with_status,
)
from paneflow.operators.lists import concat_lists, records, window_lists, wrap
from paneflow.operators.panes import (
    early_panes,
    event_time_instants,
    final_panes,
    late_panes,
    on_time_and_refires,
)
from paneflow.operators.skew import HotGroups, hot_groups
from paneflow.operators.watermark import batch_watermark, row_watermark

__all__ = [
    "ALLOWED",
    "LATE",
    "ON_TIME",
    "HotGroups",
    "accepted_rows",
    "batch_watermark",
    "concat_lists",
    "early_panes",
    "event_time_instants",
    "final_panes",
    "hot_groups",
    "late_count",
    "late_panes",
    "late_rows",
    "on_time_and_refires",
    "records",
    "row_watermark",
    "window_lists",
    "with_status",
    "wrap",
]
