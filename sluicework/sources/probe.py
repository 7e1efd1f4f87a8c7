"""Checks before a scan begins: access, the cursor's fields, and the user's time zone."""

from __future__ import annotations

import warnings
from datetime import datetime

from ..plans.offsets import FORMAT
from .client import ApiError, Client, _cell

# Names of the time zone that timestamps must be in.
UTC = ("utc", "gmt", "etc/utc", "etc/gmt", "universal")
_MEANING = {
    400: "the query or a field of the projection was refused",
    401: "the credentials were refused",
    403: "the user may not read this table or one of its fields",
    404: "there is no such table or view, or the API doesn't show it",
}


class ProbeError(RuntimeError):
    """Why a table cannot be scanned."""


def probe(client: Client, table: str, query: str, *, ts: str, sys_id: str, version: str = "sys_mod_count", **how) -> bool:
    """Read one row: whether there is one. No access, a hidden cursor field or a bad timestamp raise."""
    try:
        rows = client.list(table, query, fields=[sys_id, ts, version], limit=1, **how)
    except ApiError as e:
        raise ProbeError(f"{table}: HTTP {e.status}, {_MEANING.get(e.status, 'the request failed')}. {e}") from e
    if not rows:
        return False
    for name in (sys_id, ts):
        if name not in rows[0]:
            raise ProbeError(f"{table}: the cursor's field {name!r} is missing: hidden, or no column of the table or view (seen: {', '.join(sorted(rows[0]))})")
    value = _cell(rows[0][ts])
    try:
        datetime.strptime(value, FORMAT)
    except ValueError as e:
        raise ProbeError(f"{table}: {ts!r} is {value!r}, not yyyy-MM-dd HH:mm:ss; look at the user's date format and time zone, or the field's type") from e
    return True


def is_utc(zone: str) -> bool:
    return zone.strip().lower() in UTC


def check_time_zone(client: Client, user: str | None) -> str | None:
    """Warn if the user's own time zone can be read and isn't UTC, for filters on time follow it. Never raises."""
    if not user or not user.strip() or "^" in user:
        return None
    try:
        rows = client.list("sys_user", f"user_name={user}", fields=["user_name", "time_zone"], limit=1)
    except Exception:  # noqa: BLE001  the table may be hidden, and a scan doesn't need it
        return None
    zone = _cell(rows[0].get("time_zone")) if rows else ""
    if zone and not is_utc(zone):
        warnings.warn(f"the time zone of {user!r} is {zone!r}, not UTC: the cursor will be off", stacklevel=2)
    return zone or None
