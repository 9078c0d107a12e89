"""Readers and writers for the ledger, the contact table and the send log."""

from ledgerday.sources.contacts import read_contacts, read_contacts_jdbc
from ledgerday.sources.ledger import read_ledger, read_ledger_jdbc, write_ledger
from ledgerday.sources.sendlog import (
    empty_send_log, log_versions, read_latest_send_log, read_send_log, send_log_documents, write_next_send_log,
    write_send_log,
)

__all__ = [
    "read_contacts", "read_contacts_jdbc", "read_ledger", "read_ledger_jdbc", "write_ledger",
    "empty_send_log", "log_versions", "read_latest_send_log", "read_send_log", "send_log_documents",
    "write_next_send_log", "write_send_log",
]
