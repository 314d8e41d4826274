"""prospect: campaign / propensity analytics as Spark DataFrame, SQL and MLlib jobs."""

from prospect.session import get_session, scratch_path
from prospect.spec import CONTACTS, TableSpec

__all__ = ["get_session", "scratch_path", "TableSpec", "CONTACTS"]
