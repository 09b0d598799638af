"""Hand-made items and plain-Python results to hold the engine against."""

from __future__ import annotations

from datetime import datetime, timedelta
from types import SimpleNamespace as Item

from charlake.config import PROFILE_FIELDS
from charlake.schemas import ITEMS

T0 = datetime(2025, 9, 1, 8, 0, 0)


def at(minutes: int) -> datetime:
    return T0 + timedelta(minutes=minutes)


def item(user, kind, ts, messages=None, feedback=None, created="ts", **profile) -> tuple:
    """A row of the item table. Messages are (role, text) pairs, feedback is (type, comment, option)."""
    sk = f"{kind}#{ts.isoformat() if ts else '?'}"
    listed = None if messages is None else [(i, role, text, None) for i, (role, text) in enumerate(messages)]
    return (
        user, sk, kind, ts, ts if created == "ts" else created,
        tuple(profile.get(f) for f in PROFILE_FIELDS), listed, feedback,
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, ITEMS)


def plain(row: tuple) -> Item:
    return Item(user=row[0], sk=row[1], kind=row[2], ts=row[3], profile=dict(zip(PROFILE_FIELDS, row[5])),
                messages=[(r, t) for _, r, t, _ in row[6] or []], feedback=row[7])


def last_exchange(messages):
    users = [i for i, (r, _) in enumerate(messages) if r.lower() == "user"]
    replies = [i for i, (r, _) in enumerate(messages) if r.lower() in ("bot", "assistant", "system")]
    asked = messages[users[-1]][1] if users else ""
    later = [i for i in replies if users and i > users[-1]] or replies[-1:]
    return " ".join(asked.split()), " ".join(messages[later[0]][1].split()) if later else ""


def feedback_matches(rows):
    """{(user, sk): (asked, replied) or None}, by comparing every feedback with every conversation."""
    items = [plain(r) for r in rows]
    out = {}
    for f in items:
        if f.kind != "FEEDBACK" or not f.user or f.ts is None:
            continue
        before = sorted(
            (c for c in items if c.kind == "CONVERSATION" and c.user == f.user and c.ts is not None and c.ts <= f.ts),
            key=lambda c: (c.ts, c.sk),
        )
        pairs = [last_exchange(c.messages) for c in before]
        asked = [p for p in pairs if p[0]]
        out[f.user, f.sk] = asked[-1] if asked else pairs[0] if pairs else None
    return out
