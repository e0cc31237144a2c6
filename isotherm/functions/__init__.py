"""Column-level helpers: every function maps Columns to a Column (no UDFs)."""

from isotherm.functions.calendar import (  # noqa: F401
    add_months_index, calendar_parts, decade, month_index, month_start,
)
from isotherm.functions.coords import parse_coordinate, signed_coordinate  # noqa: F401
from isotherm.functions.labels import (  # noqa: F401
    climatic_month, climatic_season, cut_right_closed, hemisphere, latitude_zone,
    meteorological_season, outlier_side, temperature_class,
)
from isotherm.functions.safe import (  # noqa: F401
    inf_to_null, negative_to_null, safe_divide, try_date, try_double,
)
from isotherm.functions.text import (  # noqa: F401
    blank_to_null, compose_label, split_label, squeeze_text,
)
