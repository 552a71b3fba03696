"""Readings that several test modules make."""


def seconds(text: str) -> int:
    """Wall-clock seconds of ``yyyy-MM-dd HH:mm:ss``."""
    import calendar
    import time

    return calendar.timegm(time.strptime(text, "%Y-%m-%d %H:%M:%S"))


def readings(spark, rows):
    """(feed_id, time text or seconds, arrival, value) rows as readings."""
    rows = [(f, t if isinstance(t, int) else seconds(t), a, float(v)) for f, t, a, v in rows]
    return spark.createDataFrame(rows, "feed_id string, t bigint, arrival bigint, value double")


def random_readings(n, feeds=3, seed=1, span_days=3, late=0.2):
    """Grid readings with ties and late arrivals; the first feed holds half of them."""
    import random

    rng = random.Random(seed)
    start = seconds("2024-01-30 22:00:00")
    rows = []
    for arrival in range(n):
        slot = arrival * span_days * 144 // n
        if rng.random() < late:
            slot = max(0, slot - rng.randrange(0, 40))
        feed = "hot" if rng.random() < 0.5 else f"f{rng.randrange(feeds)}"
        rows.append((feed, start + slot * 600, arrival, round(rng.uniform(0, 100), 2)))
    return rows
