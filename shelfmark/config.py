"""Names and sizes shared by the jobs, passed in explicitly."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Names:
    """Where a catalog lives: one database, one root folder."""

    database: str = "catalog_search"
    root: str = "catalog_search"
    products: str = "products"
    queries: str = "queries"
    labels: str = "labels"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def index(self, model: str) -> str:
        return f"{self.root}/index/{model}"


#: Results returned per query unless the caller asks otherwise.
TOP_K = 5

#: Decimal places kept in a score. Ranking uses the kept places and then the
#: item id, so the order does not depend on partitioning or summation order.
SCORE_DIGITS = 6

#: Largest vector block, in bytes, that may be sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

#: Most rows of one side that a single search cell may hold.
CELL_ROWS = 20_000

#: A join key with fewer rows than this is never split.
HOT_ROWS = 100_000
