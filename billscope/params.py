"""Report parameters: every date a job depends on is passed in, never read from a clock."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class ReportParams:
    as_of: dt.date
    renewal_gap_days: int = 180
    first_pay_date: dt.date = dt.date(2020, 1, 1)
    outbox_priority: int = 50
    outbox_user: int = 43
    first_weekday: int = 7  # ISO number of the day a week starts on
    tracker_site: str = "main"  # site id of the tracked service
    sign_up_event: tuple[str, str, str] = ("Site", "Trial", "sign_up")  # topic, category, action
    campaign_event: tuple[str, str] = ("Campaign", "campaign_parts")  # category, action
    list_name: str = "existing_cards"
    list_suffix: str = "_List"
    card_url: str = "https://example.org/cards/"

    @property
    def yesterday(self) -> dt.date:
        return self.as_of - dt.timedelta(days=1)
