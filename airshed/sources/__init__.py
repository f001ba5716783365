"""Scans: CSV readers, driver tables, object listings, JSON documents."""

from airshed.sources.files import (  # noqa: F401
    lookup_from_rows, read_lookup, read_partitioned, read_raw, standardise_columns,
    with_source_file,
)
from airshed.sources.listing import list_objects  # noqa: F401
from airshed.sources.messages import parse_estimates, parse_notifications  # noqa: F401
from airshed.sources.tables import read_table  # noqa: F401
