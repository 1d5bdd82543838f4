"""One query per operator or plan; each runs over its whole tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.raw import given, raw
from ledgerloom import schemas
from ledgerloom.functions import parse, rules
from ledgerloom.operators import audit, conform, encode, impute, joins, labels, scale
from ledgerloom.operators.attach import attach
from ledgerloom.operators.quantiles import group_quantiles
from ledgerloom.plans import backfill as plan
from ledgerloom.plans import bronze, gold, silver
from ledgerloom.plans.calendar import month_spine, month_starts
from ledgerloom.schemas import SNAPSHOT
from ledgerloom.sources.csv import read_csv
from ledgerloom.sources.jobs import side_by_side
from ledgerloom.sources.scratch import Scratch
from ledgerloom.sources.snapshots import (
    legacy_path,
    read_legacy_snapshots,
    read_snapshots,
    snapshot_slice,
    write_snapshots,
)
from ledgerloom.sources.versions import VersionedTable

FIRST_MONTH, LAST_MONTH = "2023-01-01", "2024-12-01"


def month_of(column: str):
    return F.trunc(F.col(column).cast("date"), "MM")


def orders_by_month(spark, sf) -> DataFrame:
    return given(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", month_of("o_orderdate").alias(SNAPSHOT)
    )


def events_by_day(spark, sf, *columns) -> DataFrame:
    return given(spark, sf, "events").select(
        "event_id", F.col("ts").cast("date").alias(SNAPSHOT), *columns
    )


# --- labels -----------------------------------------------------------------


def label_store(spark, sf):
    ledger = labels.enrich_ledger(raw(spark, sf, "loan_daily"))
    return labels.build_labels(ledger, dpd=30, mob=6)


def ledger_dpd(spark, sf):
    return labels.enrich_ledger(raw(spark, sf, "loan_daily")).select(
        "loan_id", SNAPSHOT, "installments_missed", "first_missed_date", "dpd"
    )


def clean_ledger(spark, sf):
    return labels.enrich_ledger(raw(spark, sf, "loan_daily"))


# --- sources, sinks, snapshots ----------------------------------------------


def slice_of_snapshots(spark, sf):
    return snapshot_slice(orders_by_month(spark, sf), ["1996-03-01", "1997-10-01"])


def replicated_snapshots(spark, sf):
    customers = given(spark, sf, "customer").select("c_custkey", "c_name")
    return snapshot_slice(customers, ["2023-01-01", "2023-02-01"], undated="replicate")


def snapshot_audit(spark, sf):
    return audit.row_counts(orders_by_month(spark, sf))


def partitioned_roundtrip(spark, sf):
    """Write all months, rewrite one of them, read everything back."""
    path = Scratch(spark).path("orders")
    rows = orders_by_month(spark, sf)
    write_snapshots(rows, path)
    month = ["1996-03-01"]
    write_snapshots(snapshot_slice(rows, month), path, dates=month)
    return read_snapshots(spark, path, rows.schema)


def interrupted_publish(spark, sf):
    """A month is written but not published, as by a driver that is lost; another
    one is published after it."""
    path = Scratch(spark).path("orders")
    rows = orders_by_month(spark, sf)
    write_snapshots(rows, path)
    twice = rows.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    lost = snapshot_slice(twice, ["1996-03-01"])
    lost.write.partitionBy(SNAPSHOT).parquet(f"{path}/{VersionedTable(spark, path, SNAPSHOT).new_run()}")
    write_snapshots(snapshot_slice(twice, ["1997-10-01"]), path, dates=["1997-10-01", "1992-05-01"])
    return read_snapshots(spark, path)


def csv_ingest(spark, sf):
    path = Scratch(spark).path("customer-csv")
    source = given(spark, sf, "customer").withColumn("opened", F.lit("2023-01-01"))
    source.write.option("header", True).csv(path)
    types = {
        "c_custkey": "bigint",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "opened": "date",
    }
    return conform.enforce_schema(read_csv(spark, path, types), types)


def month_spine_gaps(spark, sf):
    """Order months against a calendar that reaches two years past them."""
    months = orders_by_month(spark, sf)
    bounds = months.agg(
        F.min(SNAPSHOT).alias("start"), F.add_months(F.max(SNAPSHOT), 24).alias("end")
    )
    return audit.snapshot_coverage(month_spine(bounds), months)


# --- parsing and schema -----------------------------------------------------


def _dirty_sizes(spark, sf):
    return given(spark, sf, "part").select(
        "p_partkey",
        F.expr(
            "CASE p_partkey % 7 WHEN 0 THEN concat(cast(p_size AS string), '_') "
            "WHEN 1 THEN concat('__', cast(p_size AS string), '__') "
            "WHEN 2 THEN concat(cast(p_size AS string), '.7') WHEN 3 THEN '' "
            "WHEN 4 THEN concat(cast(p_size AS string), 'e1') "
            "WHEN 5 THEN concat('-', cast(p_size AS string), '00000000000') "
            "ELSE cast(p_size AS string) END"
        ).alias("raw"),
    )


def strip_parse_int(spark, sf):
    return _dirty_sizes(spark, sf).select(
        "p_partkey", parse.strip_parse_int(F.col("raw")).alias("size")
    )


def parse_int(spark, sf):
    return _dirty_sizes(spark, sf).select("p_partkey", parse.parse_int(F.col("raw")).alias("size"))


def strip_parse_float(spark, sf):
    dirty = F.expr(
        "CASE c_custkey % 5 WHEN 0 THEN concat('_', cast(c_acctbal AS string), '_') "
        "WHEN 1 THEN '_' WHEN 2 THEN concat(cast(c_acctbal AS string), ' USD') "
        "ELSE cast(c_acctbal AS string) END"
    )
    return given(spark, sf, "customer").select(
        "c_custkey", parse.strip_parse_double(dirty).alias("balance")
    )


def enforce_schema(spark, sf):
    """Text columns to types; ``no_such`` is ignored, ``status`` passes through."""
    text = given(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.expr("CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE cast(o_custkey AS string) END").alias(
            "customer"
        ),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
        F.col("o_orderstatus").alias("status"),
    )
    types = {
        "key": "bigint",
        "price": "double",
        "customer": "int",
        "day": "date",
        "no_such": "int",
    }
    return conform.enforce_schema(text, types)


# --- cleaning rules ---------------------------------------------------------


def null_out_of_range(spark, sf):
    return given(spark, sf, "customer").select(
        "c_custkey", rules.null_out_of_range(F.col("c_acctbal"), 0, 9000).alias("balance")
    )


def fill_median(spark, sf):
    holes = events_by_day(
        spark, sf, F.expr("CASE WHEN event_id % 5 <> 0 THEN value END").alias("value")
    )
    return impute.fill_median(holes, ["value"], scratch=Scratch(spark))


def replace_above_p99(spark, sf):
    return impute.replace_above_quantile(
        events_by_day(spark, sf, "value"), {"value": "value"}, scratch=Scratch(spark)
    )


def replace_above_p99_lineitem(spark, sf):
    """Outliers of one column replaced by the median of another."""
    lines = given(spark, sf, "lineitem").select(
        "l_orderkey",
        month_of("l_shipdate").alias(SNAPSHOT),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
    )
    columns = {"price": "price", "quantity": "price"}
    return impute.replace_above_quantile(lines, columns, scratch=Scratch(spark))


def quantiles_by_month(spark, sf):
    lines = given(spark, sf, "lineitem").select(
        month_of("l_shipdate").alias(SNAPSHOT),
        F.col("l_extendedprice").alias("price"),
        F.col("l_partkey").alias("part"),
        F.col("l_linenumber").alias("line"),
    )
    wanted = {"price": [0.5, 0.99, 0.07, 0.14], "part": [0.5, 0.07], "line": [0.5, 0.99]}
    return group_quantiles(lines, wanted, [SNAPSHOT], scratch=Scratch(spark))


def approx_median_error(spark, sf):
    """The exact median per ship month, the rows below it, and by how many ranks the
    sketched median lies farther from the middle than 1 % of the rows."""
    lines = given(spark, sf, "lineitem").select(
        month_of("l_shipdate").alias(SNAPSHOT), F.col("l_extendedprice").alias("price")
    )
    sketch = group_quantiles(lines, {"price": [0.5]}, [SNAPSHOT], accuracy=100)
    exact = group_quantiles(lines, {"price": [0.5]}, [SNAPSHOT], scratch=Scratch(spark))
    both = sketch.withColumnRenamed("price_p50", "sketched").join(
        exact.withColumnRenamed("price_p50", "median"), SNAPSHOT
    )
    price, n = F.col("price"), F.count(F.lit(1))
    below, upto = F.count_if(price < F.col("sketched")), F.count_if(price <= F.col("sketched"))
    beyond = F.greatest(F.lit(0.0), below - (n * 0.51 + 1), n * 0.49 - 1 - upto)
    return (
        attach(lines, both, [SNAPSHOT])
        .groupBy(SNAPSHOT, "median")
        .agg(
            n.alias("rows"),
            F.count_if(price < F.col("median")).alias("below"),
            beyond.alias("ranks_beyond"),
        )
    )


def valid_regex_or(spark, sf):
    names = given(spark, sf, "customer").select(
        F.col("c_name").alias("text"),
        rules.valid_or(F.col("c_name"), r"^Customer#\d+[02468]$").alias("valid"),
    )
    urls = given(spark, sf, "pages").select(
        F.col("url").alias("text"),
        rules.valid_or(F.col("url"), r"^https?://[a-z]+\.example\.com/[a-z]+/\d+$", "bad url").alias(
            "valid"
        ),
    )
    return names.unionAll(urls)


def placeholder_to(spark, sf):
    priority = F.expr(
        "CASE o_orderkey % 6 WHEN 0 THEN '_______' WHEN 1 THEN '  ' WHEN 2 THEN NULL "
        "WHEN 3 THEN ' _______ ' ELSE o_orderpriority END"
    )
    status = F.expr(
        "CASE o_orderkey % 5 WHEN 0 THEN '_' WHEN 1 THEN ' _' WHEN 2 THEN NULL "
        "ELSE o_orderstatus END"
    )
    return given(spark, sf, "orders").select(
        "o_orderkey",
        rules.placeholder_to(priority, ["_______", ""], trim=True).alias("priority"),
        rules.placeholder_to(status, ["_"]).alias("status"),
    )


def null_to(spark, sf):
    return events_by_day(
        spark,
        sf,
        rules.null_to(F.expr("CASE WHEN event_id % 4 <> 0 THEN event_type END"), rules.UNKNOWN).alias(
            "event_type"
        ),
    )


def _holes(spark, sf):
    return given(spark, sf, "part").selectExpr(
        "p_partkey",
        "CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS size",
        "CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END AS price",
        "CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS type",
    )


def fill_constants(spark, sf):
    return impute.fill_constants(_holes(spark, sf), {"size": 0, "type": 0})


def fill_all_numeric(spark, sf):
    return impute.fill_all_numeric(_holes(spark, sf))


# --- cleaned tables ---------------------------------------------------------


def clean_clickstream(spark, sf):
    return silver.clean_clickstream(raw(spark, sf, "clickstream"))


STRICT = silver.CleaningRules(null_too=True, drop_pii=True)


def clean_attributes(spark, sf, choices=silver.CleaningRules()):
    return silver.clean_attributes(raw(spark, sf, "attributes"), choices, Scratch(spark))


def clean_financials(spark, sf, choices=silver.CleaningRules()):
    return silver.clean_financials(raw(spark, sf, "financials"), choices, Scratch(spark))


# --- features ---------------------------------------------------------------

TERMS = ["ring", "hot", "small ring"]
TEXT_TERMS = ["the", "queque", "Elle"]


def membership_flags(spark, sf):
    return given(spark, sf, "part").select(
        "p_partkey",
        *[
            rules.membership_flag(F.col("p_name"), t).alias(schemas.flag_name(t)) for t in TERMS
        ],
    )


def text_flags(spark, sf):
    return given(spark, sf, "documents").select(
        "doc_id",
        *[
            rules.membership_flag(F.col("text"), t).alias(schemas.flag_name(t))
            for t in TEXT_TERMS
        ],
    )


LOAN_TERMS = ["Loan", "Auto Loan", "Student Loan", "Personal Loan"]


def derived_financials(spark, sf):
    """Exact loan flags and partial durations of the loan texts."""
    loans, age = F.col("Type_of_Loan"), F.col("Credit_History_Age")
    return raw(spark, sf, "financials").select(
        "Customer_ID",
        *[rules.membership_flag(loans, t, exact=True).alias(schemas.flag_name(t)) for t in LOAN_TERMS],
        rules.duration_months(age, missing_as_zero=True).alias("months"),
    )


def dropped_rows_lenient(spark, sf):
    """Fewer rows are incomplete where years alone are a duration."""
    scratch = Scratch(spark)
    choices = gold.FeatureRules(exact_loans=True, missing_as_zero=True)
    return gold.audit_dropped(*_silver(spark, sf, scratch), scratch, choices=choices)


def duration_months(spark, sf):
    text = F.expr(
        "CASE p_partkey % 6 WHEN 0 THEN concat(cast(p_size AS string), ' Years') "
        "WHEN 1 THEN concat(cast(p_size AS string), ' Months') WHEN 2 THEN NULL "
        "WHEN 3 THEN '1 Year and 1 Month' "
        "ELSE concat(cast(p_size AS string), ' Years and ', cast(p_partkey % 12 AS string), "
        "' Months') END"
    )
    return given(spark, sf, "part").select("p_partkey", rules.duration_months(text).alias("months"))


def _typed_events(spark, sf):
    return events_by_day(
        spark, sf, F.expr("CASE WHEN event_id % 9 <> 0 THEN event_type END").alias("event_type")
    )


def level_counts(spark, sf):
    return encode.count_levels(given(spark, sf, "orders").select(
        month_of("o_orderdate").alias(SNAPSHOT), "o_orderpriority", "o_orderstatus"
    ), ["o_orderpriority", "o_orderstatus"]).withColumnRenamed("count", "n")


def index(spark, sf):
    events = _typed_events(spark, sf)
    levels = encode.fit_levels(events, ["event_type"], Scratch(spark))
    return encode.index_columns(events, levels)


def index_texts(spark, sf):
    """A vocabulary as large as the table: whole texts of documents, per source."""
    docs = given(spark, sf, "documents").select("doc_id", "source", "text", "lang")
    levels = encode.fit_levels(docs, ["text", "lang"], Scratch(spark), by=["source"])
    return encode.index_columns(docs, levels).drop("text")


def index_props(spark, sf):
    events = events_by_day(
        spark, sf, "event_type", F.expr("CASE WHEN event_id % 9 <> 0 THEN props END").alias("props")
    )
    levels = encode.fit_levels(events, ["event_type", "props"], Scratch(spark))
    return encode.index_columns(events, levels)


def index_frozen(spark, sf):
    """Every day encoded with the vocabulary of the first one."""
    events = _typed_events(spark, sf)
    levels = encode.fit_levels(events, ["event_type"], Scratch(spark))
    days = [r[0] for r in events.select(SNAPSHOT).distinct().collect()]  # dates
    return encode.index_columns(events, encode.frozen(levels, min(days), days))


def one_hot_vectors(spark, sf):
    """Sparse ML vectors, taken apart into their stored form."""
    events, scratch = _typed_events(spark, sf), Scratch(spark)
    levels = encode.fit_levels(events, ["event_type"], scratch)
    vectors = encode.with_vectors(encode.one_hot_columns(events, levels), ["event_type_ohe"], scratch)
    stored = F.unwrap_udt("event_type_ohe")
    return vectors.select(
        "event_id",
        SNAPSHOT,
        stored["size"].alias("size"),
        F.get(stored["indices"], F.lit(0)).alias("index"),
        F.get(stored["values"], F.lit(0)).alias("value"),
    )


def one_hot(spark, sf):
    events = _typed_events(spark, sf)
    levels = encode.fit_levels(events, ["event_type"], Scratch(spark))
    slots = encode.dense(F.col("event_type_ohe"))
    return encode.one_hot_columns(events, levels).select(
        "event_id",
        SNAPSHOT,
        F.col("event_type_ohe.size").alias("size"),
        *[slots[i].alias(f"slot_{i}") for i in range(5)],
    )


def skip_nulls_minmax(spark, sf):
    events = events_by_day(
        spark,
        sf,
        F.expr("CASE WHEN event_id % 5 <> 0 THEN value END").alias("value"),
        F.expr("CASE WHEN event_id % 7 = 0 THEN cast('NaN' AS double) ELSE value * 2 END").alias("twice"),
        F.lit(3).alias("constant"),
    )
    columns = ["value", "twice", "constant"]
    return scale.scale_min_max(scale.skip_incomplete(events, columns), columns)


def min_max_limits(spark, sf):
    return scale.fit_min_max(orders_by_month(spark, sf), ["o_totalprice", "o_custkey"])


def _customers(spark, sf):
    customers = given(spark, sf, "customer").selectExpr(
        "c_custkey AS user_id", "c_mktsegment", "c_acctbal"
    )
    orders = given(spark, sf, "orders")
    return customers, orders


def _spent(orders):
    return orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("largest")
    )


def _join(spark, tables, pieces):
    hot = None
    if pieces:
        counts = Scratch(spark).stage(joins.key_counts(tables, "user_id"), "counts")
        hot = joins.hot_keys(counts, "user_id", pieces=pieces)
    return joins.feature_join(tables[0], tables[1:], "user_id", hot=hot)


def feature_join(spark, sf, *, pieces=None):
    customers, orders = _customers(spark, sf)
    clicks = events_by_day(spark, sf, "user_id", "event_type")
    return _join(spark, [clicks, customers, _spent(orders)], pieces)


def feature_join_fanout(spark, sf, *, pieces=None):
    """Side table with several rows per customer: one result row for each."""
    customers, orders = _customers(spark, sf)
    each = orders.selectExpr("o_custkey AS user_id", "o_orderkey", "o_totalprice")
    return _join(spark, [events_by_day(spark, sf, "user_id"), customers, each], pieces)


PRODUCT_KEYS = {
    "events": "CASE WHEN event_id % 20 = 0 THEN -1 ELSE event_id % 30 END",
    "nation": "CASE WHEN n_nationkey % 2 = 0 THEN -1 ELSE n_nationkey END",
    "region": "CASE WHEN r_regionkey % 2 = 0 THEN -1 ELSE r_regionkey END",
}


def feature_join_product_hot(spark, sf):
    """A key that is rare in the long table, but not in the tables' product."""
    tables = [
        given(spark, sf, table).selectExpr(f"{key} AS user_id", f"{column} AS {column}")
        for (table, key), column in zip(
            PRODUCT_KEYS.items(), ("event_id", "n_nationkey", "r_regionkey"), strict=True
        )
    ]
    return _join(spark, tables, 64)


def flat(features: DataFrame) -> DataFrame:
    """Feature store with its vectors as scalar columns."""
    return features.select(
        "Customer_ID",
        SNAPSHOT,
        *[F.col("numeric_features")[i].alias(c) for i, c in enumerate(schemas.NUMERIC_FEATURES)],
        *[
            F.col("scaled_numeric_features")[i].alias(f"{c}_scaled")
            for i, c in enumerate(schemas.NUMERIC_FEATURES)
        ],
        *[F.col(f"{c}_ohe.size").alias(f"{c}_size") for c in schemas.CATEGORIES],
        *[F.col(f"{c}_ohe.slot").alias(f"{c}_slot") for c in schemas.CATEGORIES],
    )


def _silver(spark, sf, scratch):
    cleaners = {
        "clickstream": silver.clean_clickstream,
        "attributes": partial(silver.clean_attributes, scratch=scratch),
        "financials": partial(silver.clean_financials, scratch=scratch),
    }
    jobs = {t: lambda t=t, clean=clean: scratch.stage(clean(raw(spark, sf, t)), t) for t, clean in cleaners.items()}
    return list(side_by_side(spark, jobs).values())


def feature_store(spark, sf, **options):
    """Source tables through silver to the feature store, stored in between."""
    scratch = Scratch(spark)
    return flat(gold.build_features(*_silver(spark, sf, scratch), scratch, **options))


def dropped_rows(spark, sf):
    scratch = Scratch(spark)
    return gold.audit_dropped(*_silver(spark, sf, scratch), scratch)


def legacy_slices(spark, sf):
    """One CSV file per month in the older naming, written and read again."""
    folder = Scratch(spark).path("legacy")
    day = F.expr("make_date(2023, month(snapshot_date), 1)")
    rows = orders_by_month(spark, sf).withColumn(SNAPSHOT, day)
    days = month_starts("2023-01-01", "2023-12-01")
    for day in days:
        one = rows.where(F.col(SNAPSHOT) == F.lit(day))
        one.write.option("header", True).csv(legacy_path(folder, "orders", day, "csv"))
    read = read_legacy_snapshots(spark, folder, "orders", dates=days, suffix="csv")
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", SNAPSHOT: "date"}
    return conform.enforce_schema(read, types)


# --- whole runs, CSV to gold ------------------------------------------------


def _csv_sources(spark, sf, scratch, tables) -> dict[str, str]:
    """Compressed, and in files that a task each can read, as such files cannot be cut."""
    paths = {}
    for table in tables:
        paths[table] = scratch.path(f"csv/{table}")
        (
            raw(spark, sf, table)
            .write.option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("compression", "gzip")
            .option("zlib.compress.level", "BEST_SPEED")
            .option("maxRecordsPerFile", 1_000_000)
            .csv(paths[table])
        )
    return paths


def backfill_features(spark, sf):
    scratch = Scratch(spark)
    lake, dates = scratch.path("lake"), month_starts(FIRST_MONTH, LAST_MONTH)
    sources = _csv_sources(spark, sf, scratch, bronze.FEATURE_TABLES)
    bronze.ingest_features(spark, sources, lake, dates)
    silver.refine_features(spark, lake, dates)
    return flat(gold.publish_features(spark, lake, dates))


def backfill_labels(spark, sf):
    scratch = Scratch(spark)
    lake, dates = scratch.path("lake"), month_starts(FIRST_MONTH, LAST_MONTH)
    sources = _csv_sources(spark, sf, scratch, [bronze.LEDGER_TABLE])
    bronze.ingest_ledger(spark, sources[bronze.LEDGER_TABLE], lake, dates)
    silver.refine_ledger(spark, lake, dates)
    return gold.publish_labels(spark, lake, dates, dpd=30, mob=6)


def backfill_audit(spark, sf):
    """Row counts of every layer, table and snapshot after a full backfill."""
    scratch = Scratch(spark)
    lake = scratch.path("lake")
    sources = _csv_sources(spark, sf, scratch, [*bronze.FEATURE_TABLES, bronze.LEDGER_TABLE])
    plan.backfill(spark, sources, lake, FIRST_MONTH, LAST_MONTH, layers=["bronze"])
    scratch.remove("csv")  # bronze holds their rows
    plan.backfill(spark, sources, lake, FIRST_MONTH, LAST_MONTH, layers=["silver", "gold"])
    counts = plan.audit(spark, lake)
    return counts.withColumnsRenamed({"table": "table_name", "rows": "n"})


QUERIES = {
    "q_label_store": label_store,
    "q_ledger_dpd": ledger_dpd,
    "q_clean_ledger": clean_ledger,
    "q_snapshot_slice": slice_of_snapshots,
    "q_replicated_snapshots": replicated_snapshots,
    "q_snapshot_audit": snapshot_audit,
    "q_partitioned_roundtrip": partitioned_roundtrip,
    "q_interrupted_publish": interrupted_publish,
    "q_csv_ingest": csv_ingest,
    "q_month_spine_gaps": month_spine_gaps,
    "q_strip_parse_int": strip_parse_int,
    "q_parse_int": parse_int,
    "q_strip_parse_float": strip_parse_float,
    "q_enforce_schema": enforce_schema,
    "q_null_out_of_range": null_out_of_range,
    "q_fill_median": fill_median,
    "q_replace_above_p99": replace_above_p99,
    "q_replace_above_p99_lineitem": replace_above_p99_lineitem,
    "q_quantiles_by_month": quantiles_by_month,
    "q_approx_median_error": approx_median_error,
    "q_valid_regex_or": valid_regex_or,
    "q_placeholder_to": placeholder_to,
    "q_null_to": null_to,
    "q_fill_constants": fill_constants,
    "q_fill_all_numeric": fill_all_numeric,
    "q_clean_clickstream": clean_clickstream,
    "q_clean_attributes": clean_attributes,
    "q_clean_attributes_strict": partial(clean_attributes, choices=STRICT),
    "q_clean_financials": clean_financials,
    "q_clean_financials_strict": partial(clean_financials, choices=STRICT),
    "q_clean_financials_published": partial(clean_financials, choices=silver.PUBLISHED_RULES),
    "q_membership_flags": membership_flags,
    "q_text_flags": text_flags,
    "q_duration_months": duration_months,
    "q_derived_financials": derived_financials,
    "q_level_counts": level_counts,
    "q_index": index,
    "q_index_medium": index_props,
    "q_index_large": index_texts,
    "q_index_frozen": index_frozen,
    "q_one_hot": one_hot,
    "q_one_hot_vectors": one_hot_vectors,
    "q_skip_nulls_minmax": skip_nulls_minmax,
    "q_min_max_limits": min_max_limits,
    "q_feature_join": feature_join,
    "q_feature_join_salted": partial(feature_join, pieces=200),
    "q_feature_join_fanout": feature_join_fanout,
    "q_feature_join_fanout_salted": partial(feature_join_fanout, pieces=200),
    "q_feature_join_product_hot": feature_join_product_hot,
    "q_feature_store": feature_store,
    "q_feature_store_as_of": partial(feature_store, as_of=True),
    "q_dropped_rows": dropped_rows,
    "q_dropped_rows_lenient": dropped_rows_lenient,
    "q_legacy_slices": legacy_slices,
    "q_backfill_features": backfill_features,
    "q_backfill_labels": backfill_labels,
    "q_backfill_audit": backfill_audit,
}
