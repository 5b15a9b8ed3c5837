"""The layers from posts and users to features, each built on demand from the ones below."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import decay, engagement, features
from plumbline.sources import sample
from plumbline.sources.ingest import cut, written

#: What the layers and the analytics of a project's posts are made of.
POST = [
    "post_id", "project_keyword", "user_x_id", "retweeted_post_id", "replied_post_id", "quoted_post_id", "view_count", "reply_count", "retweet_count", "favorite_count",
    "content_score", "post_created_at", "is_reply", "is_quote", "is_retweet", "is_post",
]


class Lineage:
    """Lazy DataFrames of all layers over a source ``read(name)`` of users, posts, user_posts and nucleus_posts."""

    def __init__(self, read: Callable[[str], DataFrame]):
        self._read = read

    @classmethod
    def of_sample(cls, spark: SparkSession, sf_dir: str) -> Lineage:
        return cls(lambda name: sample.load(spark, sf_dir, name))

    @cached_property
    def users(self) -> DataFrame:
        return self._read("users")

    @cached_property
    def posts(self) -> DataFrame:
        return self._read("posts")

    @cached_property
    def user_posts(self) -> DataFrame:
        return self._read("user_posts")

    @cached_property
    def nucleus_posts(self) -> DataFrame:
        return self._read("nucleus_posts")

    @cached_property
    def scores(self) -> DataFrame:
        return decay.decay_scores(self.posts, self.users, "project")

    @cached_property
    def global_scores(self) -> DataFrame:
        return decay.decay_scores(self.user_posts, self.users, "global")

    @cached_property
    def engagement(self) -> DataFrame:
        return engagement.engagement(self.posts, self.users)

    @cached_property
    def user_engagement(self) -> DataFrame:
        return engagement.user_engagement(self.user_posts, self.users)

    @cached_property
    def audience(self) -> DataFrame:
        """What features are made of: narrower than the engagement table, or that table where it is stored."""
        return engagement.audience(self.posts, self.users)

    @cached_property
    def crowd(self) -> DataFrame:
        """The same rows from one pass over the posts, without names and ranks, or that table where it is stored."""
        return engagement.crowd(self.posts)

    @cached_property
    def user_audience(self) -> DataFrame:
        return engagement.user_audience(self.user_posts, self.users)

    @cached_property
    def features(self) -> DataFrame:
        return features.features(self.crowd, names=self.users)

    @cached_property
    def hourly_features(self) -> DataFrame:
        return features.features(self.crowd, burst="hour", names=self.users)

    def spread_features(self) -> DataFrame:
        """Features by tasks that hold hours of busy posts. Without such posts they come the shorter way."""
        hot = cut(features.busy(engagement.targets(self.posts)))
        if hot.isEmpty():
            return features.features(self.crowd, names=self.users)
        return features.features(self.audience, by_hour=True, crowded=hot)

    def of_project(self, project: str) -> Lineage:
        """The layers of one project over its posts as written once to the shared folder, for queries that use several layers: they
        don't make the posts anew for each. Texts and times of coming aren't kept."""
        posts = self.posts.where(F.col("project_keyword") == project)
        kept = written(posts.select([c for c in POST if c in posts.columns]))
        return Lineage({"posts": kept, "users": self.users}.__getitem__)

    def _around(self, project: str, user: str) -> DataFrame:
        """One author's posts in a project and what others replied to them or quoted of them. The ids of one author's posts go to
        all tasks, so that others' rows are left out where they are read."""
        posts = self.posts.where(F.col("project_keyword") == project)
        own = posts.where(F.col("user_x_id") == user)
        others = posts.where(~F.col("user_x_id").eqNullSafe(F.lit(user)))
        ids = F.broadcast(own.select(F.col("post_id").alias("_own")))
        return own.unionByName(others.join(ids, F.coalesce("replied_post_id", "quoted_post_id") == F.col("_own"), "left_semi"))

    def engagement_of(self, project: str, user: str) -> DataFrame:
        """The engagement table of one author's posts in a project."""
        return engagement.engagement(self._around(project, user), self.users).where(F.col("root_user_id") == user)

    def features_of(self, project: str, user: str) -> DataFrame:
        """The features of one author's posts in a project. They depend on no other author's."""
        return features.features(engagement.audience(self._around(project, user), self.users).where(F.col("root_user_id") == user))

    @cached_property
    def user_features(self) -> DataFrame:
        return features.features(self.user_audience, burst="59:59", distinct_participants=True, prev_overlap=True)


#: The order of builds: engagement, then what reads it; layers with a project are laid out by it.
SOURCES = {"engagement": ("audience", "crowd"), "user_engagement": ("user_audience",)}
STORED = ("engagement", "user_engagement", "scores", "global_scores", "features", "user_features")


def materialise(lineage: Lineage, root: str, layers: tuple[str, ...] = STORED, parts: int = 8) -> Lineage:
    """Write the layers as Parquet under ``root``, each from the written ones below it, and return a lineage that reads
    them. Project layers are partitioned by project, so a query of one project reads one folder, of ``parts`` files at most."""
    out = Lineage(lineage._read)
    for layer in (name for name in STORED if name in layers):
        df = getattr(out, layer)
        writer = df.write.mode("overwrite")
        if "project_keyword" in df.columns:
            post = "root_post_id" if "root_post_id" in df.columns else "reply_post_id"
            dealt = df.repartition("project_keyword", F.pmod(F.xxhash64(post), F.lit(parts)))
            writer = dealt.write.mode("overwrite").partitionBy("project_keyword")
        writer.parquet(f"{root}/{layer}")
        stored = df.sparkSession.read.schema(df.schema).parquet(f"{root}/{layer}")
        setattr(out, layer, stored)
        for source in SOURCES.get(layer, ()):
            setattr(out, source, stored)
    return out
