"""Every operator as a query over the given tables, with an equivalent SQL text where one exists."""

from wikiloom.catalog import (  # noqa: F401
    landed,
    logs,
    markup,
    movement,
    names,
    spaces,
    trees,
    versions,
)
from wikiloom.catalog.registry import QUERIES, SQL  # noqa: F401
