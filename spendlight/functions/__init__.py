from spendlight.functions.calendar import calendar_columns, date_key
from spendlight.functions.labels import (
    channel_color, pick, roas_band, roas_color, roas_direction, roas_status, roas_verdict,
)
from spendlight.functions.metrics import (
    METRICS, MONEY_TYPE, money_sum, money_units, off_grid, ratio, ratio_sql, units_sum, with_metrics,
)
from spendlight.functions.privacy import mask, masked_key, short_id

__all__ = [
    "METRICS",
    "MONEY_TYPE",
    "calendar_columns",
    "channel_color",
    "date_key",
    "mask",
    "masked_key",
    "money_sum",
    "money_units",
    "off_grid",
    "pick",
    "ratio",
    "ratio_sql",
    "roas_band",
    "roas_color",
    "roas_direction",
    "roas_status",
    "roas_verdict",
    "short_id",
    "units_sum",
    "with_metrics",
]
