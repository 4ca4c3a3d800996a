"""Usage and subscription analytics for a data portal, as Spark DataFrame functions."""

from tallyport.config import LEGACY, OPEN_YEARS, PORTAL, WORKBOOK, Profile

__all__ = ["LEGACY", "OPEN_YEARS", "PORTAL", "WORKBOOK", "Profile"]
