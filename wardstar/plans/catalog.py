"""All registered queries."""

# In this order the tables that later queries share are built step by step.
from wardstar.plans import scalar_queries  # noqa: F401  isort: skip
from wardstar.plans import warehouse_queries  # noqa: F401  isort: skip
from wardstar.plans import text_queries  # noqa: F401  isort: skip
from wardstar.plans import search_queries  # noqa: F401  isort: skip
from wardstar.plans.registry import QUERIES, SQL  # noqa: F401
