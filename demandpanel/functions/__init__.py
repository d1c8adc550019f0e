from demandpanel.functions.columns import LABELS, require_columns, row_mean
from demandpanel.functions.frequency import Frequency, parse_frequency

__all__ = ["LABELS", "Frequency", "parse_frequency", "require_columns", "row_mean"]
