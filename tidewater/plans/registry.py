"""Import every query family so their ``register`` calls run; import this
module (not the families one by one) to get the complete catalog."""

from tidewater.plans import catalog
from tidewater.plans import q_cdm  # noqa: F401
from tidewater.plans import q_track  # noqa: F401
from tidewater.plans import q_buddy  # noqa: F401
from tidewater.plans import q_summary  # noqa: F401
from tidewater.plans import q_level  # noqa: F401
from tidewater.plans import q_drifter  # noqa: F401
from tidewater.plans import q_meta  # noqa: F401
from tidewater.plans import q_ingest  # noqa: F401
from tidewater.plans import q_files  # noqa: F401
from tidewater.plans import q_runs  # noqa: F401
from tidewater.plans import q_blocks  # noqa: F401

QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES
