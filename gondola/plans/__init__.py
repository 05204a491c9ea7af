"""Registered query keys. Importing this package fills ``REGISTRY``."""

from gondola.plans.registry import REGISTRY, Query, register  # noqa: F401
from gondola.plans import silver_q  # noqa: F401
from gondola.plans import catalog_q  # noqa: F401
from gondola.plans import text_q  # noqa: F401
from gondola.plans import vectors_q  # noqa: F401
from gondola.plans import prices_q  # noqa: F401
from gondola.plans import sources_q  # noqa: F401
from gondola.plans import receipts_q  # noqa: F401
from gondola.plans import loop_q  # noqa: F401
from gondola.plans import propagate_q  # noqa: F401
from gondola.plans import stream_q  # noqa: F401
from gondola.plans import archives_q  # noqa: F401
from gondola.plans import more_q  # noqa: F401
from gondola.plans import gold_q  # noqa: F401
from gondola.plans import tables_q  # noqa: F401
