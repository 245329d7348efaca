"""Conditions that stop a booking run."""

from __future__ import annotations


class BookingStopped(RuntimeError):
    """The run cannot go on; ``log`` is where the reasons were written."""

    def __init__(self, reason: str, log: str) -> None:
        super().__init__(f"{reason}, see {log}")
        self.log = log


class MissingBeneficiaryCodes(BookingStopped):
    pass


class MissingLedgerKeys(BookingStopped):
    pass


class NotBalanced(BookingStopped):
    pass
