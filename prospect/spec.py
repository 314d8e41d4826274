"""Column roles of a contact table."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    """Roles of the columns of one flat table.

    ``leaky`` columns are known only after the outcome (kept out of features), ``temporal``
    categoricals get a calendar treatment instead of a frequency one.
    """

    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    label: str = "y"
    id: str = "contact_id"
    leaky: tuple[str, ...] = ()
    temporal: tuple[str, ...] = ()
    positive: str = "yes"
    negative: str = "no"

    @property
    def plain_categorical(self) -> tuple[str, ...]:
        return tuple(c for c in self.categorical if c not in self.temporal)


# Column roles of the contact view built from the star schema (see sources/contacts.py).
CONTACTS = TableSpec(
    categorical=("job", "marital", "education", "nation", "month", "day_of_week", "poutcome"),
    numeric=("pdays", "previous", "emp_var_rate", "cons_conf_idx", "euribor3m", "nr_employed"),
    label="y",
    id="contact_id",
    leaky=("duration",),
    temporal=("month", "day_of_week"),
)

# Calendar order used by the temporal profile.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
