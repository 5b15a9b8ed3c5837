"""Write-once decay: score only replies that have no score yet, from the stored history; old rows never change.

The multipliers of stored rows are frozen, and a new reply's product takes only entries strictly
earlier than itself, so this is not the retroactive result. Each replier's new replies depend on one
another in turn, which windows can't say; repliers are independent, so tasks go through rows that are sorted by replier and
hold one replier at a time: those that have new replies, each with its last ``reset`` of history.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.decay import COLUMNS, FLOOR, GLOBAL, LOCAL, THIRTY_DAYS
from plumbline.sources.ingest import written

BATCH = 20_000  # rows that a task hands on at once


def _half_up(value: float) -> float:
    return float(int(value * 100 + 0.5)) / 100


def score_new(history: list[tuple[pd.Timestamp, str, float]], new: list[dict], number: int, reset: timedelta, other: float, far: str) -> list[dict]:
    """Score one replier's ``new`` rows in order of time. history: (time, author, multiplier) of stored rows. The entries that
    are active at a row are kept in a queue with counts, so a row costs what enters and leaves it."""
    out = []
    entries = deque(sorted(history, key=lambda e: e[0]))
    same_time: list[tuple] = []  # entries of the current time, which don't count for one another
    authors = Counter(e[1] for e in entries)
    multipliers = Counter(e[2] for e in entries)
    ahead = deque()  # stored entries that aren't earlier than the row

    def leave(e: tuple) -> None:
        authors[e[1]] -= 1
        multipliers[e[2]] -= 1

    def enter(e: tuple) -> None:
        entries.append(e)
        authors[e[1]] += 1
        multipliers[e[2]] += 1

    for row in new:
        t, author, base = row["post_created_at"], row["original_author_x_id"], row["replier_base_score"]
        if same_time and same_time[0][0] < t:
            # what is still ahead of the row can't be older than what was just added
            same_time, added = [], same_time
            ahead = deque(sorted([*added, *ahead], key=lambda e: e[0]))
        while ahead and ahead[0][0] < t:
            enter(ahead.popleft())
        while entries and entries[-1][0] >= t:
            e = entries.pop()
            leave(e)
            ahead.appendleft(e)
        while entries and entries[0][0] <= t - reset:
            leave(entries.popleft())
        floor = _half_up(base * FLOOR)
        local = 1 + authors[author]
        halves, others = multipliers[LOCAL], multipliers[other]
        effective = max(_half_up(base * (LOCAL**halves * (other**others if other not in (1.0, LOCAL) else 1.0))), floor)
        kind = "FIRST_REPLY" if not entries else "LOCAL_DECAY" if local > 1 else far
        m = {"FIRST_REPLY": 1.0, "LOCAL_DECAY": LOCAL}.get(kind, other)
        number += 1
        same_time.append((t, author, m))
        contribution = effective if m == 1.0 else max(_half_up(effective * m), floor)
        out.append(row | {"effective_score": effective, "contribution_score": contribution, "reply_number": number, "local_reply_count": local, "decay_type": kind})
    return out


def append_new(replies: DataFrame, stored: DataFrame, scope: str = "project", reset: timedelta = THIRTY_DAYS, new_author: float = GLOBAL) -> DataFrame:
    """Score rows of the rows of ``replies`` that ``stored`` has no score of, numbered on from the replier's last number."""
    keys = ["project_keyword", "replier_x_id"] if scope == "project" else ["replier_x_id"]
    ids = ["project_keyword", "reply_post_id"] if scope == "project" else ["reply_post_id"]
    fresh = written(replies.join(stored.select(*ids), ids, "left_anti"))
    touched = fresh.groupBy(*keys).agg(F.min("post_created_at").alias("_from"))
    far = "GLOBAL_DECAY" if new_author != 1.0 else "NEW_AUTHOR"
    past = stored.join(touched, keys)
    numbers = past.groupBy(*keys).agg(F.max("reply_number").alias("_number"))
    recent = past.where(F.col("post_created_at") > F.col("_from") - F.lit(reset))
    old = recent.select(*keys, "reply_post_id", "original_post_id", "original_author_x_id", "post_created_at", F.lit(None).cast("double").alias("replier_base_score"), F.col("decay_type").alias("_kind"))
    new = fresh.select(*keys, "reply_post_id", "original_post_id", "original_author_x_id", "post_created_at", "replier_base_score", F.lit(None).cast("string").alias("_kind"))
    both = old.unionByName(new).join(numbers, keys, "left")
    schema = ", ".join(f"`{c}` {t}" for c, t in stored.select(*keys[:-1], *COLUMNS).dtypes)

    def solve(rows: list[dict]) -> list[dict]:
        """The new rows of one replier, whose rows come in order of time and id."""
        history = [(r["post_created_at"], r["original_author_x_id"], {"FIRST_REPLY": 1.0, "NEW_AUTHOR": 1.0, "LOCAL_DECAY": LOCAL}.get(r["_kind"], new_author)) for r in rows if r["_kind"] is not None]
        number = 0 if pd.isna(rows[0]["_number"]) else int(rows[0]["_number"])
        return score_new(history, [r for r in rows if r["_kind"] is None], number, reset, new_author, far)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = lambda rows: pd.DataFrame(rows, columns=[*keys[:-1], *COLUMNS])
        own: list[dict] = []
        done: list[dict] = []
        key = None
        for batch in batches:
            for row in batch.astype({"_kind": object}).to_dict("records"):
                row["_kind"] = None if pd.isna(row["_kind"]) else row["_kind"]
                at = tuple(row[k] for k in keys)
                if at != key and own:
                    done += solve(own)
                    own = []
                    if len(done) >= BATCH:
                        yield frame(done)
                        done = []
                key = at
                own.append(row)
        if own:
            done += solve(own)
        if done:
            yield frame(done)

    ordered = both.repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_last("post_created_at"), "reply_post_id")
    return ordered.mapInPandas(run, schema)
