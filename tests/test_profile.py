"""Profiles of a join against the joined rows, look-ups, and jobs side by side."""

from __future__ import annotations

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import encode, joins
from ledgerloom.operators.profile import profile_join
from ledgerloom.operators.scale import fit_min_max, skip_incomplete
from ledgerloom.plans import gold
from ledgerloom.schemas import CUSTOMER, SNAPSHOT
from ledgerloom.sources.jobs import POOL, side_by_side

JAN, FEB = dt.date(2023, 1, 1), dt.date(2023, 2, 1)


def tables(spark, scratch, seed=4):
    """Few customers, one of them with most rows; nulls and NaN anywhere."""
    rng = random.Random(seed)

    def customer():
        return rng.choice(["hot"] * 5 + ["a", "b", "c", "only" + str(rng.randrange(9)), None])

    def number():
        return rng.choice([None, float("nan"), float(rng.randrange(5)), rng.gauss(0, 9)])

    clicks = [(customer(), rng.choice([JAN, FEB, None]), rng.choice([None, 1, 7]), number()) for _ in range(90)]
    one = [(customer(), rng.choice(["x", "y", None]), number()) for _ in range(25)]
    two = [(customer(), rng.choice(["p", None]), rng.randrange(3), rng.choice([None, 4])) for _ in range(25)]
    return [
        scratch.stage(spark.createDataFrame(rows, kind), name)
        for name, rows, kind in (
            ("clicks", clicks, f"{CUSTOMER} string, {SNAPSHOT} date, u int, v double"),
            ("one", one, f"{CUSTOMER} string, k string, w double"),
            ("two", two, f"{CUSTOMER} string, l string, m int, z int"),
        )
    ]


NUMERIC, CATEGORIES = ["u", "v", "w", "z"], ["k", "l", "m"]


def rows_of(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def test_profile_equals_the_joined_rows(spark, scratch):
    clicks, one, two = tables(spark, scratch)
    found = profile_join(clicks, [one, two], scratch, numeric=NUMERIC, categories=CATEGORIES)
    joined = joins.feature_join(clicks, [one, two])
    kept = skip_incomplete(joined, NUMERIC)
    assert kept.count() > 5

    counts = found.key_counts()
    assert rows_of(counts, *counts.columns) == rows_of(joins.key_counts([clicks, one, two]), *counts.columns)
    limits = [f"{c}_{end}" for c in NUMERIC for end in ("min", "max")]
    fitted = joined.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("joined"))
    fitted = fitted.join(
        kept.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("kept")).withColumnRenamed(SNAPSHOT, "s"),
        F.col(SNAPSHOT).eqNullSafe(F.col("s")), "left",
    ).drop("s").fillna(0)
    assert rows_of(found.totals(), SNAPSHOT, "joined", "kept") == rows_of(fitted, SNAPSHOT, "joined", "kept")
    assert rows_of(found.totals().where("kept > 0"), SNAPSHOT, *limits) == rows_of(
        fit_min_max(kept, NUMERIC), SNAPSHOT, *limits
    )
    for i, own in enumerate((["k"], ["l", "m"])):
        columns = [SNAPSHOT, *own, "count"]
        assert rows_of(found.tuples(i), *columns) == rows_of(encode.count_tuples(joined, own), *columns)
    both = encode.levels_of_tuples(found.tuples(0)).unionAll(encode.levels_of_tuples(found.tuples(1)))
    columns = [SNAPSHOT, "column", "value", "count"]
    assert rows_of(both, *columns) == rows_of(encode.count_levels(joined, CATEGORIES), *columns)


def test_profile_answers_without_the_tables(spark, scratch):
    clicks, one, two = tables(spark, scratch)
    found = profile_join(clicks, [one, two], scratch, numeric=NUMERIC, categories=CATEGORIES)
    for answer in (found.key_counts(), found.totals(), found.tuples(0), found.tuples(1)):
        assert answer.inputFiles() and all("/profile-" in path for path in answer.inputFiles())


def test_the_store_reads_the_clickstream_once_more(spark, scratch, monkeypatch):
    """Once for the profile, once for the join."""
    from checks import queries as q
    from conftest import SF_DIR

    seen = []

    def counted(df, keys, numeric, real=gold.profile_join.__globals__["profile_rows"]):
        seen.append(df.inputFiles()[0])
        return real(df, keys, numeric)

    monkeypatch.setitem(gold.profile_join.__globals__, "profile_rows", counted)
    silver = q._silver(spark, SF_DIR, scratch)
    store = gold.build_features(*silver, scratch)
    path = silver[0].inputFiles()[0].rsplit("/", 1)[0]
    assert len([p for p in seen if p.startswith(path)]) == 1
    leaves = store._jdf.queryExecution().optimizedPlan().collectLeaves()
    outputs = [leaves.apply(i).output().mkString(",") for i in range(leaves.size())]
    assert len([names for names in outputs if "fe_1#" in names]) == 1


def test_all_columns_meet_the_vocabulary_in_one_join(spark, scratch):
    rows = [(i, JAN if i % 3 else None, f"x{i % 4}", None if i % 5 == 0 else f"y{i % 7}", i % 2) for i in range(60)]
    df = scratch.stage(spark.createDataFrame(rows, f"i int, {SNAPSHOT} date, x string, y string, z int"), "rows")
    levels = encode.fit_levels(df, ["x", "y", "z"], scratch)
    got = {r.i: r for r in encode.index_columns(df, levels).collect()}
    order = {}
    for c in ("x", "y", "z"):
        for day in (JAN, None):
            values = [getattr(r, c) for r in got.values() if r[SNAPSHOT] == day and getattr(r, c) is not None]
            order[c, day] = sorted(set(values), key=lambda v: (-values.count(v), str(v)))
    for r in got.values():
        for c in ("x", "y", "z"):
            known = order[c, r[SNAPSHOT]]
            expected = len(known) if r[c] is None else known.index(r[c])
            assert r[f"{c}_index"] == expected


def test_a_large_vocabulary_shuffles_the_rows_once(spark, scratch):
    """Wide rows have one exchange, whatever the number of encoded columns."""
    rows = [(i, JAN, f"x{i}", f"y{i}", f"z{i}", "wide" * 9) for i in range(50)]
    kind = f"i int, {SNAPSHOT} date, x string, y string, z string, wide string"
    df = scratch.stage(spark.createDataFrame(rows, kind), "rows")
    levels = encode.fit_levels(df, ["x", "y", "z"], scratch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = encode.index_columns(df, levels)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges, text = 0, plan.splitlines()
    for at, line in enumerate(text):
        if "FileScan" in line and "wide" in line:
            depth = line.index("FileScan")
            above = [t for t in text[:at] if "Exchange hashpartitioning" in t and t.index("Exchange") < depth]
            # the rows' branch is the first of the join
            exchanges += len(above[:1])
    assert exchanges == 1 and plan.count("wide") and "CartesianProduct" not in plan


def test_jobs_run_side_by_side(spark):
    meeting = threading.Barrier(3, timeout=60)

    def job(name):
        def run():
            meeting.wait()  # only passes if all three run at once
            return spark.sparkContext.getLocalProperty(POOL), spark.range(10).where(f"id < {len(name)}").count()

        return run

    got = side_by_side(spark, {name: job(name) for name in ("a", "bb", "ccc")})
    assert got == {"a": ("a", 1), "bb": ("bb", 2), "ccc": ("ccc", 3)}
    assert spark.sparkContext.getLocalProperty(POOL) is None
    assert side_by_side(spark, {}) == {}


def test_the_first_error_is_raised_after_all_have_ended(spark):
    ended = []

    def fails():
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        side_by_side(spark, {"bad": fails, "good": lambda: ended.append(spark.range(3).count())})
    assert ended == [3]


def test_store_categories_are_covered(spark):
    """Each category belongs to one side table, so tuples cover all of them."""
    assert set(schemas.PLAIN_CATEGORIES) <= {*schemas.ATTRIBUTES, *schemas.FINANCIALS}
