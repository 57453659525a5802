"""Which columns and codes play which role in an activity log.

The same operators run on the offline game log (string codes ``'1'``/``'2'``)
and on the driver's ``events`` table (``signup``/``view``).
"""

from __future__ import annotations

from dataclasses import dataclass

from tessera.schemas import LOGIN_CODES, REGISTER_CODES


@dataclass(frozen=True)
class Roles:
    user: str = "userName"
    ts: str = "event_ts"
    event: str = "eventType"
    register: tuple = REGISTER_CODES
    login: tuple = LOGIN_CODES
    # DATE partition column of a log written with ``write_event_log``; used only when present
    date: str = "event_date"

    @property
    def active(self) -> tuple:
        return tuple(self.register) + tuple(self.login)


GAMELOG_ROLES = Roles()
EVENTS_ROLES = Roles(user="user_id", ts="ts", event="event_type", register=("signup",), login=("view",))
