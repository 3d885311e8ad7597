"""Column roles and fixed domain values.

Every operator takes a DataFrame plus a :class:`Roles` spec instead of
hard-coded column lists, so the same code runs on any table that declares
which of its columns play which role.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results)
# ---------------------------------------------------------------------------

# Missing-value token sets, compared after trim + lower-case (or upper-case
# for the wind set). AUDIT is the general set, WIND the set used when
# normalising wind directions, RESIDUAL the set of the final null report.
AUDIT_TOKENS = ("", "na", "nan", "null", "n/a", "none", "missing")
WIND_TOKENS = ("NA", "N/A", "NULL", "NONE", "MISSING", "-", "?")
RESIDUAL_TOKENS = ("na", "n/a", "null", "none", "missing", "-", "?")

# Sixteen compass points, clockwise from north in 22.5 degree steps.
DIRECTIONS = ("N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
              "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW")

YES_NO = ("Yes", "No")

# Plausible physical ranges per numeric attribute (inclusive).
VALID_RANGES = {
    "Rainfall": (0.0, 1000.0),
    "Evaporation": (0.0, 500.0),
    "Sunshine": (0.0, 24.0),
    "WindGustSpeed": (0.0, 200.0),
    "WindSpeed9am": (0.0, 200.0),
    "WindSpeed3pm": (0.0, 200.0),
    "Humidity9am": (0.0, 100.0),
    "Humidity3pm": (0.0, 100.0),
    "Cloud9am": (0.0, 9.0),
    "Cloud3pm": (0.0, 9.0),
    "Pressure9am": (800.0, 1100.0),
    "Pressure3pm": (800.0, 1100.0),
    "Temp9am": (-50.0, 60.0),
    "Temp3pm": (-50.0, 60.0),
    "MinTemp": (-50.0, 60.0),
    "MaxTemp": (-50.0, 60.0),
}

# The 16 numeric attributes of the audit, in the reference's listing order.
AUDIT_NUMERIC = ("MinTemp", "MaxTemp", "Temp9am", "Temp3pm",
                 "Rainfall", "Evaporation", "Sunshine",
                 "WindGustSpeed", "WindSpeed9am", "WindSpeed3pm",
                 "Humidity9am", "Humidity3pm",
                 "Pressure9am", "Pressure3pm",
                 "Cloud9am", "Cloud3pm")

# Row means used as model features: output -> inputs.
ROW_MEANS = {
    "Temp_avg": ("MaxTemp", "MinTemp", "Temp9am", "Temp3pm"),
    "Pressure_avg": ("Pressure9am", "Pressure3pm"),
    "Humidity_avg": ("Humidity9am", "Humidity3pm"),
    "WindSpeed_avg": ("WindGustSpeed", "WindSpeed9am", "WindSpeed3pm"),
}

# Columns dropped before the feature vector is assembled.
FEATURE_DROP = ("RainToday", "Location", "Date", "Sunshine",
                "MinTemp", "MaxTemp", "Temp9am", "Temp3pm",
                "Pressure9am", "Pressure3pm",
                "Humidity9am", "Humidity3pm",
                "WindGustSpeed", "WindSpeed9am", "WindSpeed3pm",
                "Cloud9am", "Cloud3pm",
                "WindGustDir", "WindDir9am", "WindDir3pm",
                "Month", "Day", "Year", "DayMonth",
                "Evaporation")


@dataclass(frozen=True)
class Roles:
    """Declarative column roles of an observation table."""

    columns: tuple = (
        "Date", "Location", "MinTemp", "MaxTemp", "Rainfall", "Evaporation",
        "Sunshine", "WindGustDir", "WindGustSpeed", "WindDir9am", "WindDir3pm",
        "WindSpeed9am", "WindSpeed3pm", "Humidity9am", "Humidity3pm",
        "Pressure9am", "Pressure3pm", "Cloud9am", "Cloud3pm", "Temp9am",
        "Temp3pm", "RainToday", "RainTomorrow")
    date: str = "Date"
    date_format: str = "yyyy-MM-dd"
    location: str = "Location"
    label: str = "RainTomorrow"
    label_domain: tuple = YES_NO
    positive: str = "Yes"
    rain_today: str = "RainToday"
    rain_amount: str = "Rainfall"
    normal: tuple = ("MinTemp", "MaxTemp", "Temp9am", "Temp3pm",
                     "Pressure9am", "Pressure3pm")
    non_normal: tuple = ("Rainfall", "Evaporation", "Sunshine", "Humidity9am",
                         "Humidity3pm", "Cloud9am", "Cloud3pm", "WindGustSpeed",
                         "WindSpeed9am", "WindSpeed3pm")
    discrete: tuple = ("Cloud9am", "Cloud3pm")
    directions: tuple = ("WindGustDir", "WindDir9am", "WindDir3pm")
    binary: tuple = ("RainToday", "RainTomorrow")
    outliers: tuple = ("Cloud9am", "Cloud3pm", "Rainfall", "Evaporation",
                       "WindGustSpeed", "WindSpeed9am", "WindSpeed3pm")
    audit_numeric: tuple = AUDIT_NUMERIC
    ranges: dict = field(default_factory=lambda: dict(VALID_RANGES))
    categorical: tuple = ("Location", "WindGustDir", "WindDir9am", "WindDir3pm")
    row_key: str = "h"
    doubles: tuple = ("MinTemp", "MaxTemp", "Temp9am", "Temp3pm", "Rainfall",
                      "Evaporation", "Sunshine", "Pressure9am", "Pressure3pm",
                      "Humidity9am", "Humidity3pm", "WindGustSpeed",
                      "WindSpeed9am", "WindSpeed3pm")
    ints: tuple = ("Cloud9am", "Cloud3pm")
    medians: str = "measured"  # of groups by keys that grow with the data: see group_stats
    # Decimal places of fitted means before they fill gaps; None keeps them in full.
    mean_decimals: int | None = None

    @property
    def numeric(self) -> tuple:
        """Normal followed by non-normal numeric columns."""
        return tuple(self.normal) + tuple(self.non_normal)

    @property
    def continuous(self) -> tuple:
        """Non-normal numeric columns that are not discrete."""
        return tuple(c for c in self.non_normal if c not in self.discrete)

    def with_(self, **kw) -> "Roles":
        return replace(self, **kw)

    def check(self, names, needed=None) -> None:
        """Raise for columns that are ``needed`` (default: all of the roles) and not among ``names``."""
        absent = [c for c in dict.fromkeys(self.columns if needed is None else needed) if c not in set(names)]
        if absent:
            raise ValueError(f"columns that the table lacks: {', '.join(absent)}")


WEATHER = Roles()
