"""DataFrame -> DataFrame building blocks."""

from vigilo.operators.calendar import calendar, calendar_fields, calendar_spanning
from vigilo.operators.dedupe import first_by, latest_by, pick_by_priority
from vigilo.operators.flags import any_flag, code_flags
from vigilo.operators.joins import SaltPlan, SkewSpec, skew_join

__all__ = [
    "SaltPlan",
    "SkewSpec",
    "any_flag",
    "calendar",
    "calendar_fields",
    "calendar_spanning",
    "code_flags",
    "first_by",
    "latest_by",
    "pick_by_priority",
    "skew_join",
]
