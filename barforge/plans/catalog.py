"""Imports every query module so that their registrations take effect."""

from barforge.plans import analytics_q, listing_q, merge_q, publish_q, report_q, stream_q  # noqa: F401
from barforge.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
