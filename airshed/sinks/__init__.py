"""Writers: date-partitioned CSV, single CSV, lookup CSV, keyed ledger."""

from airshed.sinks.files import write_by_date, write_csv, write_lookup  # noqa: F401
from airshed.sinks.ledger import compact_ledger, read_dead_letters, read_ledger, upsert_ledger  # noqa: F401
