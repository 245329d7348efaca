"""The text key that links an item-price row to its ledger, as SQL expressions."""

from __future__ import annotations

LEDGER_KEY_PARTS = ("transaction_type", "item_status", "payment_method", "shipment_provider_name")

# Key of a booked row; NULL as soon as one part is NULL.
BOOKING_KEY = " || '-' || ".join(LEDGER_KEY_PARTS)
# Key of a ledger-map row; a NULL part counts as empty text.
MAP_KEY = " || '-' || ".join(f"coalesce({part}, '')" for part in LEDGER_KEY_PARTS)
