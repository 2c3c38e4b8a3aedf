"""Values that stored tables already contain, plus the settings of one installation."""

from __future__ import annotations

from dataclasses import dataclass

# Ledger and lag states.
RUNNING, SUCCESS, EMPTY, FAIL = "Running", "Success", "Empty", "Fail"
UNDECIDED, WAIT, RERUN, UPDATING = "TBD", "Wait", "ReRun", "Updating"

# Destinations, and the site group each narrow destination receives.
MAIN_DESTINATION = "DS_Server"
GROUP_DESTINATIONS = {"Noah1": "Noah1_Server", "Noah2": "Noah2_Server"}

# Halls whose accounts are not unique, and the ids used when halls are unknown.
EXCLUDED_HALLS = ("SE", "3Sing", "TGP2", "PS2")
FALLBACK_EXCLUDED_TYPES = (35, 67, 68, 139)

# Fixed value: only this category trusts the timezone inferred from timestamps.
INFERRED_CATEGORY = "機率"

# Output clock, slack before a source counts as late, waiting hours before an alert.
OUTPUT_UTC_OFFSET_HOURS = 8
LAG_SLACK_MINUTES = 10
LAG_ALERT_HOURS = 3

# One row of work: a physical source table.
SOURCE_KEYS = ["LinkServerName", "DBName", "MonthDB", "TableName", "Type"]
ROLLUP_COLUMNS = [
    "DatePlayed", "GameAccount", "SiteId", "GameTypeSourceId",
    "Commissionable", "WagersCount", "PayOff", "WinsCount",
]
LEDGER_KEYS = ["Server", "Type", "Destination", "UpDateTime"]


@dataclass(frozen=True)
class Settings:
    """What differs between installations.

    shared_db      database that holds the games of several Types; its reads need a game list
    legacy_db      database that loses when a game is mapped twice
    exclude_key    lookup column compared with the excluded ids
    month_of       which end of the window names the month database: 'start' or 'end'
    trim_accounts  also ignore trailing blanks when grouping accounts
    """

    shared_db: str = "_DbShared"
    legacy_db: str = "_DbLegacy"
    exclude_key: str = "GameTypeSourceId"
    month_of: str = "start"
    trim_accounts: bool = False
    slack_minutes: int = LAG_SLACK_MINUTES
    alert_hours: int = LAG_ALERT_HOURS
