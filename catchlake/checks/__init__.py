"""The registered queries and their SQL, by family."""

from catchlake.checks import cleaning, facts, grouping, joining, movement, quality, spatial, stocks, summaries  # noqa: F401
from catchlake.checks.registry import CHECKS  # noqa: F401
