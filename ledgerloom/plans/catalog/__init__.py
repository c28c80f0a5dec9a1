"""All queries over the driver's tables; importing this package registers them."""

from ledgerloom.plans.catalog import chain, files, ledger, refining, streams  # noqa: F401
from ledgerloom.plans.catalog.base import ORACLES, QUERIES  # noqa: F401
