"""A line-by-line restatement of the decay rule, and small tables."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

POST = (
    "post_id string, project_keyword string, user_x_id string, full_text string, retweeted_post_id string, replied_post_id string, quoted_post_id string, root_post_id string, "
    "view_count int, reply_count int, retweet_count int, quote_count int, favorite_count int, content_score decimal(5,2), post_created_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"
)
USER = "x_id string, x_username string, display_name string, avatar_url string, score decimal(10,2), created_at timestamp_ntz"
DAY0 = datetime(2024, 6, 1)


def at(days: float) -> datetime:
    return DAY0 + timedelta(days=days)


def post(post_id, user, days, replied=None, quoted=None, retweeted=None, project="p", views=100, likes=10, content=None, ingest=None):
    when = at(days)
    seen = at(ingest) if ingest is not None else when
    return (post_id, project, user, f"text {post_id}", retweeted, replied, quoted, replied or post_id, views, 0, 0, 0, likes, content, when, seen, seen)


def user(x_id, score, name=None):
    return (x_id, name or f"name {x_id}", f"shown {x_id}", None, score, datetime(2024, 1, 1))


def tables(spark, posts, users):
    from decimal import Decimal

    from plumbline.operators.engagement import with_flags

    users = [(*u[:4], Decimal(str(u[4])), *u[5:]) for u in users]
    posts = [(*p[:13], None if p[13] is None else Decimal(str(p[13])), *p[14:]) for p in posts]
    return with_flags(spark.createDataFrame(posts, POST)), spark.createDataFrame(users, USER)


def round2(x):
    return math.floor(x * 100 + 0.5) / 100


def sequential(rows, scope="project", reset=timedelta(days=30), other=None):
    """rows: dicts of one table of replies, as reply_source gives them. Returns {reply id: (number, local, type, effective, contribution, active)}."""
    other = other if other is not None else 0.9 if scope == "project" else 1.0
    far = "GLOBAL_DECAY" if other != 1.0 else "NEW_AUTHOR"
    out, windows, numbers = {}, {}, {}
    for r in sorted(rows, key=lambda r: (r["post_created_at"], r["reply_post_id"])):
        key = (r.get("project_keyword"), r["replier_x_id"]) if scope == "project" else r["replier_x_id"]
        window = [e for e in windows.get(key, []) if e[0] > r["post_created_at"] - reset]
        numbers[key] = numbers.get(key, 0) + 1
        local = 1 + sum(e[1] == r["original_author_x_id"] for e in window)
        base = r["replier_base_score"]
        floor = round2(base * 0.01)
        halves, others = sum(e[2] == 0.5 for e in window), sum(e[2] == other for e in window)
        weight = 0.5**halves * (other**others if other != 1.0 else 1.0)
        effective = max(round2(base * weight), floor)
        m, kind = (1.0, "FIRST_REPLY") if not window else (0.5, "LOCAL_DECAY") if local > 1 else (other, far)
        contribution = effective if m == 1.0 else max(round2(effective * m), floor)
        window.append((r["post_created_at"], r["original_author_x_id"], m))
        windows[key] = window
        out[r["reply_post_id"]] = (numbers[key], local, kind, effective, contribution, [e[2] for e in window])
    return out
