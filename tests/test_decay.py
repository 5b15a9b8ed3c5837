import random
from datetime import timedelta

import pytest
from helpers import at, post, sequential, tables, user

from plumbline.operators import ledger
from plumbline.operators.decay import decay, decay_scores, inspect, reply_source
from plumbline.plans.refresh import difference, dirty_repliers, refresh_scores

ROOTS = [post(f"r{a}", a, -40) for a in "ABCXY"]


def scored(spark, replies, users, scope="project", **rule):
    posts, people = tables(spark, [*ROOTS, *replies], users)
    rows = decay_scores(posts, people, scope, **rule).collect()
    return {r["reply_post_id"]: r for r in rows}


def replies(who, plan):
    return [post(f"{who}{k}", who, day, replied=f"r{a}") for k, (day, a) in enumerate(plan)]


def contributions(found, who):
    return [found[k]["contribution_score"] for k in sorted((k for k in found if k.startswith(who)), key=lambda k: int(k[len(who):]))]


def test_mixed_authors(spark):
    plan = [(0, "A"), (2, "B"), (4, "A"), (9, "C"), (37, "A")]
    assert contributions(scored(spark, replies("rita", plan), [user("rita", 100)]), "rita") == [100, 90, 45, 40.5, 81]


def test_same_author_down_to_the_floor(spark):
    found = scored(spark, replies("sam", [(k, "A") for k in range(9)]), [user("sam", 10)])
    assert contributions(found, "sam") == [10, 5, 2.5, 1.25, 0.63, 0.32, 0.16, 0.1, 0.1]


@pytest.mark.parametrize("base", [950, 6350])
def test_powers_are_those_of_c(spark, base):
    """950.00 * 0.9^4 lies between two cents, where the last bit of the power decides."""
    plan = [(k, a) for k, a in enumerate("ABCXYA")]
    posts, people = tables(spark, [*ROOTS, *replies("pow", plan)], [user("pow", base)])
    found = decay_scores(posts, people)
    want = sequential([r.asDict() for r in reply_source(posts, people).collect()])
    assert {r["reply_post_id"]: r["effective_score"] for r in found.collect()} == {k: v[3] for k, v in want.items()}


def test_an_entry_expires_exactly_at_the_end(spark):
    found = scored(spark, replies("eve", [(0, "A"), (30, "A")]), [user("eve", 50)])
    assert [found[k]["decay_type"] for k in ("eve0", "eve1")] == ["FIRST_REPLY", "FIRST_REPLY"]


def test_ties_are_ordered_by_id(spark):
    found = scored(spark, [post("b", "t", 1, replied="rA"), post("a", "t", 1, replied="rA")], [user("t", 100)])
    assert (found["a"]["decay_type"], found["b"]["decay_type"]) == ("FIRST_REPLY", "LOCAL_DECAY")


@pytest.mark.parametrize(("new_author", "kind", "score"), [(None, "NEW_AUTHOR", 100), (0.9, "GLOBAL_DECAY", 90)])
def test_global_rules(spark, new_author, kind, score):
    found = scored(spark, replies("g", [(0, "A"), (1, "B")]), [user("g", 100)], "global", new_author=new_author)
    assert (found["g1"]["decay_type"], found["g1"]["contribution_score"]) == (kind, score)


def test_unknown_parents_and_repliers_give_no_row(spark):
    assert not scored(spark, [post("x", "k", 1, replied="gone"), post("y", "nobody", 1, replied="rA")], [user("k", 5)])


def random_posts(seed, n=400):
    rng = random.Random(seed)
    rows = [post(f"root{k}", f"a{k % 6}", -1) for k in range(12)]
    return rows + [post(f"q{k:04}", f"u{rng.randrange(5)}", rng.randrange(120), replied=f"root{rng.randrange(12)}", ingest=rng.randrange(160)) for k in range(n)]


@pytest.mark.parametrize("scope", ["project", "global"])
@pytest.mark.parametrize("seed", [1, 2])
def test_windows_match_the_sequential_rule(spark, scope, seed):
    posts, users = tables(spark, random_posts(seed), [user(f"u{k}", 10.37 * (k + 1)) for k in range(5)])
    source = reply_source(posts, users, scope)
    want = sequential([r.asDict() for r in source.collect()], scope)
    got = {
        r["reply_post_id"]: (r["reply_number"], r["local_reply_count"], r["decay_type"], r["effective_score"], r["contribution_score"], r["active_multipliers"])
        for r in decay(source, scope, active_multipliers=True).collect()
    }
    assert got == want


def test_one_shuffle_serves_all_windows(spark):
    posts, users = tables(spark, random_posts(3), [user("u1", 5)])
    source = reply_source(posts, users).checkpoint()
    plan = decay(source)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_inspect_counts_every_row(spark):
    posts, users = tables(spark, random_posts(4), [user(f"u{k}", 7) for k in range(5)])
    assert sum(r["n"] for r in inspect(decay_scores(posts, users)).collect()) == 400


@pytest.mark.parametrize("scope", ["project", "global"])
@pytest.mark.parametrize("since", [20, 80, 158])
def test_refresh_equals_a_full_build(spark, scope, since):
    posts, users = tables(spark, random_posts(5), [user(f"u{k}", 10.37 * (k + 1)) for k in range(5)])
    old = decay_scores(posts.where(posts.created_at <= at(since)), users, scope)
    new = refresh_scores(posts, users, old, at(since), scope)
    assert difference(new, decay_scores(posts, users, scope)).isEmpty()


def test_nothing_new_makes_nobody_dirty(spark):
    posts, users = tables(spark, random_posts(6), [user("u1", 5)])
    assert dirty_repliers(posts, users, at(500)).isEmpty()


def test_a_late_parent_and_a_changed_user_make_repliers_dirty(spark):
    posts, users = tables(spark, [post("rA", "A", -5, ingest=50), post("x", "k", 1, replied="rA"), post("y", "z", 1, replied="rB"), post("rB", "B", -5)], [user("k", 5), user("z", 5)])
    assert [r["replier_x_id"] for r in dirty_repliers(posts, users, at(10)).collect()] == ["k"]
    both = dirty_repliers(posts, users, at(10), users_since=at(-400)).collect()
    assert sorted(r["replier_x_id"] for r in both) == ["k", "z"]


def test_ledger_never_changes_stored_rows_and_scores_from_them(spark):
    plan = [post("a", "k", 0, replied="rA"), post("c", "k", 4, replied="rA"), post("b", "k", 2, replied="rB", ingest=9)]
    posts, users = tables(spark, [*ROOTS, *plan], [user("k", 100)])
    stored = decay_scores(posts.where(posts.created_at <= at(5)), users)
    new = ledger.append_new(reply_source(posts, users), stored).collect()
    assert [(r["reply_post_id"], r["reply_number"], r["decay_type"], r["contribution_score"]) for r in new] == [("b", 3, "GLOBAL_DECAY", 90.0)]
    again = stored.unionByName(ledger.append_new(reply_source(posts, users), stored))
    assert ledger.append_new(reply_source(posts, users), again).isEmpty()


def test_ledger_after_a_base_change(spark):
    first = [post("a", "k", 0, replied="rA"), post("b", "k", 2, replied="rB"), post("c", "k", 4, replied="rA")]
    posts, users = tables(spark, [*ROOTS, *first], [user("k", 100)])
    stored = decay_scores(posts, users)
    more = [*first, post("d", "k", 9, replied="rC"), post("e", "k", 10, replied="rC")]
    posts2, users2 = tables(spark, [*ROOTS, *more], [user("k", 150)])
    new = {r["reply_post_id"]: r["contribution_score"] for r in ledger.append_new(reply_source(posts2, users2), stored).collect()}
    assert new == {"d": 60.75, "e": 30.38}


def test_ledger_takes_new_authors_as_they_were_stored(spark):
    rows = [post("a", "k", 0, replied="rA"), post("b", "k", 2, replied="rB"), post("c", "k", 4, replied="rC", ingest=9)]
    posts, users = tables(spark, [*ROOTS, *rows], [user("k", 100)])
    stored = decay_scores(posts.where(posts.created_at <= at(5)), users, "global")
    new = ledger.append_new(reply_source(posts, users, "global"), stored, "global", new_author=0.9).collect()
    assert [(r["decay_type"], r["effective_score"], r["contribution_score"]) for r in new] == [("GLOBAL_DECAY", 100.0, 90.0)]


def test_scaling_the_base_scales_unrounded_types(spark):
    posts, users = tables(spark, random_posts(7), [user(f"u{k}", 64) for k in range(5)])
    _, double = tables(spark, random_posts(7), [user(f"u{k}", 128) for k in range(5)])
    a = {r["reply_post_id"]: r["decay_type"] for r in decay_scores(posts, users).collect()}
    b = {r["reply_post_id"]: r["decay_type"] for r in decay_scores(posts, double).collect()}
    assert a == b


def test_a_shorter_window_forgets_sooner(spark):
    plan = replies("v", [(0, "A"), (2, "A")])
    assert scored(spark, plan, [user("v", 10)], reset=timedelta(days=1))["v1"]["decay_type"] == "FIRST_REPLY"
