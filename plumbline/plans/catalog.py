"""The layers as SQL views, and the read-backs as SQL table functions, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans.functions import FUNCTIONS
from plumbline.plans.lineage import Lineage

VIEWS = {
    "users": "users", "posts": "posts", "user_posts": "user_posts", "nucleus_posts": "nucleus_posts", "contribution_scores": "scores",
    "global_contribution_scores": "global_scores", "engagement": "engagement", "user_engagement": "user_engagement", "features": "features", "user_features": "user_features",
}

#: Columns that a source may lack; the views have them as nulls.
OPTIONAL = {"nucleus_posts": {"is_reply_fetched": "boolean", "project_keyword": "string"}, "users": {"display_name": "string", "avatar_url": "string"}}

CAPS = "project_keyword string, leaderboard_type string, post_cap int, cap_period string, cap_start_date timestamp_ntz, project_start_date timestamp_ntz"
PROJECTS = "project_name string, start_ts bigint, end_ts bigint"


def register(spark: SparkSession, lineage: Lineage, post_caps: DataFrame | None = None, projects: DataFrame | None = None) -> None:
    """Temporary views of all layers and temporary table functions over them, in this session.

    post_caps are the caps of leaderboards, projects the dates of projects; without them defaults and no dates hold. A view is
    the layer's plan, not a result: over ``materialise``d layers the functions read the stored tables.
    """
    for view, layer in VIEWS.items():
        df = getattr(lineage, layer)
        missing = {c: F.lit(None).cast(t) for c, t in OPTIONAL.get(view, {}).items() if c not in df.columns}
        df.withColumns(missing).createOrReplaceTempView(view)
    (post_caps if post_caps is not None else spark.createDataFrame([], CAPS)).createOrReplaceTempView("post_caps")
    (projects if projects is not None else spark.createDataFrame([], PROJECTS)).createOrReplaceTempView("projects")
    for statement in FUNCTIONS.values():
        spark.sql(statement)
