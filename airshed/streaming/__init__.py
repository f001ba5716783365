"""Structured Streaming jobs."""

from airshed.streaming.inventory import inventory_stream, read_inventory  # noqa: F401
from airshed.streaming.ledger import ledger_stream, process_notice_batch  # noqa: F401
