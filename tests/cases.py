"""Small logs and a plain-Python reading of the metrics to check Spark against."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date, datetime, time, timedelta

FEED_SCHEMA = "user_id bigint, post_id bigint, action string, time timestamp_ntz"
MESSAGE_SCHEMA = "user_id bigint, receiver_id bigint, time timestamp_ntz"

D = date(2024, 3, 10)


def at(day: date, clock: time = time(12)) -> datetime:
    return datetime.combine(day, clock)


MICRO_FEED = [
    (0, 1, "view", at(D, time(10))),
    (1, 1, "view", at(D, time(0, 0, 0))),
    (1, 1, "like", at(D, time(23, 59, 59, 999999))),
    (2, 2, "like", at(D)),
    (3, 1, "other", at(D)),
    (1, 1, "view", at(D + timedelta(days=2))),
]
# Rows without a user, a post, a receiver or a time.
NULL_FEED = [
    (1, 1, "view", at(D)),
    (1, None, "view", at(D)),
    (2, 1, "like", at(D)),
    (None, 1, "view", at(D)),
    (1, 2, "view", None),
]
NULL_MESSAGES = [(1, 5, at(D)), (None, 5, at(D)), (None, None, at(D))]
MICRO_MESSAGES = [(0, 5, at(D)), (1, 5, at(D)), (4, 1, at(D))]


def random_logs(seed: int, users: int, rows: int, days: int, hot: float = 0.0):
    """Random logs; with ``hot``, that share of the rows has user 1, post 1 and receiver 1."""
    rng = random.Random(seed)

    def one():
        is_hot = rng.random() < hot
        moment = at(D + timedelta(days=int(days * rng.random() ** 2)), time(rng.randrange(24), rng.randrange(60)))
        return (1 if is_hot else rng.randrange(users)), (1 if is_hot else rng.randrange(users * 2)), moment

    feed = [(u, p, rng.choice(["view", "view", "like", "other"]), t) for u, p, t in (one() for _ in range(rows))]
    messages = [one() for _ in range(rows // 2)]
    return feed, messages


def overlap(feed, messages):
    f = {(u, t.date()) for u, _, _, t in feed}
    m = {(u, t.date()) for u, _, t in messages}
    rows = set()
    for u, d in f | m:
        fu, mu = (u if (u, d) in f else 0), (u if (u, d) in m else 0)
        kind = {(True, False): "Feed only", (False, True): "Messenger only", (True, True): "Both"}
        rows.add((fu, mu, d, kind.get((fu > 0, mu > 0), "OutOfType")))
    return rows


def cohorts(feed, horizon=7):
    """(start, dt, duration, users, first_day_users)."""
    days = defaultdict(set)
    for u, _, _, t in feed:
        days[u].add(t.date())
    counts = Counter()
    for active in days.values():
        start = min(active)
        counts.update((start, d) for d in active if (d - start).days < horizon)
    return {(s, d, (d - s).days + 1, n, counts[s, s]) for (s, d), n in counts.items()}


def posts(feed, k):
    views, likes, users = Counter(), Counter(), defaultdict(set)
    for u, p, a, _ in feed:
        views[p] += a == "view"
        likes[p] += a == "like"
        users[p].add(u)
    best = sorted(users, key=lambda p: (-views[p], p))[:k]
    return [(p, views[p], likes[p], likes[p] / views[p] if views[p] else None, len(users[p])) for p in best]


def top(ids, k):
    return sorted(Counter(ids).items(), key=lambda x: (-x[1], x[0]))[:k]


def kpis(feed, messages, as_of):
    """report_date, seven KPIs, seven retention values."""
    d = as_of - timedelta(days=1)
    feed_day = [r for r in feed if r[3].date() == d]
    message_day = [r for r in messages if r[2].date() == d]
    feed_users, senders = {r[0] for r in feed_day}, {r[0] for r in message_day}
    views, likes = (sum(r[2] == kind for r in feed_day) for kind in ("view", "like"))
    ctr = round(likes * 100 / views * 100) / 100 if views else None
    both = len({u for u in feed_users & senders if u > 0})
    week = {n: users / first for s, _, n, users, first in cohorts(feed) if s == as_of - timedelta(days=7)}
    retention = [round(week[n] * 100) / 100 if n in week else None for n in range(1, 8)]
    return (d, len(feed_users), len(senders), views, likes, ctr, len(message_day), both, *retention)
