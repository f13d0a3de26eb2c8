"""Named queries over the test tables, each with its SQL counterpart where one exists."""

from firmlens.plans import content, crawl, panel, relational  # noqa: F401
from firmlens.plans.registry import ORACLES, QUERIES  # noqa: F401
