"""One query per operator, on whole test tables. Keys pair with ``oracles``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert import config as k
from culvert import functions as fn
from culvert.operators.cut import new_table, written
from culvert.operators import joins, layout, outliers, panels, picks, quantiles
from culvert.plans import enforcement, facts, job, report, reporting, spills
from culvert.plans.attributes import attributes_of, system_attributes
from culvert.sources import (
    STAGED, Publication, as_of, read_delimited, read_published, read_snapshot, stage, write_snapshot,
)
from workload import roles
from workload.roles import CONFIG, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places: both engines sum in their own order."""
    return df.select(
        *[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def query(f: Query) -> Query:
    QUERIES[f.__name__] = lambda spark, sf: _rounded(f(spark, sf))
    return f


def _kept(df: DataFrame) -> DataFrame:
    """Stored, not cached: a query leaves nothing in the executors."""
    return written(df, "kept")


def _base(spark: SparkSession, sf: str) -> job.Base:
    return job.base(roles.tables(spark, sf), CONFIG, _kept)


def _weighted(spark: SparkSession, sf: str) -> DataFrame:
    return _base(spark, sf).weighted


def _rates_5yr(spark: SparkSession, sf: str) -> DataFrame:
    return _kept(job.baseline_rates_5yr(_base(spark, sf), CONFIG))


def _rates_12mo(spark: SparkSession, sf: str) -> DataFrame:
    return _kept(job.baseline_rates_12mo(_base(spark, sf), CONFIG))


def _first_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """First known length per asset from reports (a) and questionnaire (b)."""
    a = picks.first_row(
        roles.annual_reports(spark, sf).where("length IS NOT NULL"), ["wdid"], ["row_no"]
    ).select("wdid", F.col("length").alias("length_a"))
    b = roles.questionnaire(spark, sf).select("wdid", F.col("length").alias("length_b"))
    return joins.full_join(a, b, "wdid")


def _feeds(spark: SparkSession, sf: str) -> list[tuple[DataFrame, DataFrame]]:
    """Both spill feeds, each with the table that multiplies its rows."""
    return [
        (roles.new_spills(spark, sf), roles.annual_reports(spark, sf)),
        (roles.old_spills(spark, sf), roles.questionnaire(spark, sf)),
    ]


# --- sources -----------------------------------------------------------------


@query
def stage_spills(spark, sf):
    orders = read(spark, sf, "orders")
    start = F.lit(roles.FEED_START)
    id_, key = F.col("o_custkey").cast("string").alias("WDID"), F.col("o_orderkey").alias("row_no")
    status = F.col("o_orderpriority").alias("STATUS")
    new = orders.where(F.col("o_orderdate") >= start).select(
        id_,
        F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("ESTIMATED_SPILL_START_DATE_AND_TIME"),
        F.col("o_orderstatus").alias("SPILL_TYPE"),
        F.col("o_orderpriority").alias("APPEARANCE_POINTS"),
        status,
        key,
    )
    old = orders.where(F.col("o_orderdate") < start).select(
        id_,
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("START.DT"),
        F.col("o_orderstatus").alias("SPILL.TYPE"),
        F.col("o_orderpriority").alias("WHERE.FAILURE.OCCUR"),
        status,
        key,
    )
    staged = [stage(new, STAGED["new_spills"].columns), stage(old, STAGED["old_spills"].columns)]
    return picks.union_feeds(staged, "feed")


@query
def null_tokens(spark, sf):
    segment = F.col("c_mktsegment")
    text = (
        F.when(segment == "BUILDING", "")
        .when(segment == "MACHINERY", "NA")
        .when(segment == "FURNITURE", "#N/A")
        .otherwise(segment)
    )
    return (
        read(spark, sf, "customer")
        .withColumn("raw", text)
        .select(
            "c_custkey",
            fn.null_tokens(F.col("raw")).alias("facility_text"),
            fn.null_tokens(F.col("raw"), ("NA",)).alias("feed_text"),
        )
    )


@query
def snapshot_as_of(spark, sf):
    dated = read(spark, sf, "events").withColumn("snapshot_date", F.to_date("ts"))
    return as_of(dated, dt.date(2024, 1, 15)).select("event_id", "user_id", "event_type", "value")


def _wordy(spark, sf):
    """Orders as text with quotes, separators and line breaks, in order of their key."""
    key = F.col("o_orderkey")
    note = F.when(key % 3 == 0, F.concat(F.lit('say "'), F.col("o_orderpriority"), F.lit('", or\t'), key.cast("string")))
    return (
        read(spark, sf, "orders")
        .select(
            key.cast("string").alias("ID"),
            F.col("o_orderpriority").alias("STATUS"),
            note.otherwise(F.when(key % 3 == 1, "NA").otherwise("a,b;c")).alias("NOTE (ANY)"),
            F.date_format("o_orderdate", "M/d/yyyy").alias("DAY"),
        )
        .repartitionByRange(4, F.col("ID").cast("long"))
        .sortWithinPartitions(F.col("ID").cast("long"))
    )


def _through_files(spark, sf, sep, multiline, rows):
    path = new_table(spark, "feed")
    rows.write.option("header", True).option("sep", sep).option("escape", '"').option("emptyValue", "").csv(path)
    text = read_delimited(spark, path, sep=sep, tokens=("NA",), multiline=multiline)
    return text.select(
        F.col("ID").cast("long").alias("o_orderkey"),
        F.col("STATUS").alias("status"),
        F.col("`NOTE..ANY.`").alias("note"),
        fn.lenient_date(F.col("DAY")).alias("day"),
        "row_no",
    )


@query
def read_comma_feed(spark, sf):
    return _through_files(spark, sf, ",", False, _wordy(spark, sf))


@query
def read_tab_feed(spark, sf):
    broken = F.regexp_replace("NOTE (ANY)", ", or", ",\nor")
    return _through_files(spark, sf, "\t", True, _wordy(spark, sf).withColumn("NOTE (ANY)", broken))


@query
def snapshot_round_trip(spark, sf):
    root, day = new_table(spark, "snapshots"), dt.date(2024, 1, 15)
    events = read(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    write_snapshot(events.where("event_type = 'error'"), root, "events", dt.date(2024, 1, 14))
    write_snapshot(events.where("event_id < 0"), root, "events", day)
    write_snapshot(events, root, "events", day)
    return read_snapshot(spark, root, "events", day)


@query
def published_results(spark, sf):
    """Two tables of a run as readers get them, another run of the day having broken off."""
    root, day = new_table(spark, "published"), dt.date(2024, 1, 15)
    events = read(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    with Publication(spark, root, day) as run:
        run.add("events", events.where("event_type = 'error'"))
        types = events.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
        run.add("types", types, {"n": "EVENT COUNT"}, "csv")
    Publication(spark, root, day).add("events", events.where("event_id < 0"))
    types = read_published(spark, root, "types", day).select("event_type", F.col("EVENT COUNT").alias("type_count"), "users")
    return read_published(spark, root, "events").join(types, "event_type")


@query
def size_class_lookup(spark, sf):
    classed = roles.questionnaire(spark, sf).select(
        "wdid", fn.classify(F.col("length"), k.LENGTH_CUTS).alias("length_class")
    )
    return layout.attach_lookup(classed, k.SIZE_CLASS_TEXT, "length_class")


@query
def stage_audit(spark, sf):
    t = roles.tables(spark, sf)
    return layout.audit(
        {
            "new_spills": t["new_spills"],
            "old_spills": t["old_spills"],
            "annual_reports": t["annual_reports"],
            "clean_new": facts.clean_feed(
                t["new_spills"], t["facilities"], CONFIG, CONFIG.new_types
            ),
        },
        "wdid",
    )


# --- scalar functions --------------------------------------------------------


@query
def clean_numeric(spark, sf):
    price, flag = F.col("l_extendedprice"), F.col("l_returnflag")
    text = (
        F.when(flag == "A", F.format_number(price, 2))
        .when(flag == "N", F.concat(F.lit(" "), price.cast("string"), F.lit(" ")))
        .when(F.col("l_linestatus") == "O", F.concat(price.cast("string"), F.lit("d")))
        .otherwise("")
    )
    return (
        read(spark, sf, "lineitem")
        .withColumn("raw", text)
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_returnflag",
            fn.clean_numeric(F.col("raw")).alias("cleaned"),
            fn.plain_numeric(F.col("raw")).alias("plain"),
        )
    )


@query
def parse_dates(spark, sf):
    stamp, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", F.date_format(stamp, "M/d/yyyy h:mm:ss a"))
        .when(priority == "5-LOW", F.date_format(stamp, "MM/dd/yyyy"))
        .when(priority == "3-MEDIUM", F.concat(F.lit("02/30/"), F.date_format(stamp, "yyyy H:mm")))
        .otherwise(F.date_format(stamp, "M/d/yyyy H:mm"))
    )
    return (
        read(spark, sf, "orders")
        .withColumn("raw", text)
        .select(
            "o_orderkey",
            fn.lenient_date(F.col("raw"), "%m/%d/%Y %H:%M").alias("with_time"),
            fn.lenient_date(F.col("raw"), "%m/%d/%Y").alias("day_only"),
        )
    )


@query
def parse_month_label(spark, sf):
    label = F.date_format("o_orderdate", "dd-MMM-yy")
    text = F.when(F.col("o_orderstatus") == "F", F.upper(label)).otherwise(label)
    free = F.date_format("o_orderdate", "d MMMM, yyyy")
    return (
        read(spark, sf, "orders")
        .withColumn("raw", text)
        .withColumn("raw_free", F.when(F.col("o_orderstatus") == "P", free).otherwise(label))
        .select(
            "o_orderkey",
            fn.month_label(F.col("raw")).alias("month"),
            fn.free_date(F.col("raw_free")).alias("updated"),
        )
    )


@query
def region_code(spark, sf):
    fac = roles.facilities(spark, sf)
    return fac.groupBy(fn.region(F.col("wdid")).alias("region")).agg(F.count("*").alias("systems"))


@query
def population_class(spark, sf):
    rows = system_attributes(roles.tables(spark, sf), CONFIG)
    return rows.groupBy("population_class").agg(
        F.count("*").alias("n"), F.min("population").alias("lo"), F.max("population").alias("hi")
    )


@query
def length_class(spark, sf):
    rows = system_attributes(roles.tables(spark, sf), CONFIG)
    return rows.groupBy("length_class").agg(
        F.count("*").alias("n"), F.min("length").alias("lo"), F.max("length").alias("hi")
    )


@query
def length_discrepancy(spark, sf):
    diff = fn.rel_diff(F.col("length_a"), F.col("length_b"))
    return _first_lengths(spark, sf).select(
        "wdid", diff.alias("length_diff"), (diff > CONFIG.discrepancy_limit).alias("large")
    )


@query
def reconcile_length(spark, sf):
    a, b = F.col("length_a"), F.col("length_b")
    return _first_lengths(spark, sf).select("wdid", fn.reconcile(a, b).alias("length"))


@query
def reconcile_length_supplement(spark, sf):
    a, b = F.col("length_a"), F.col("length_b")
    return _first_lengths(spark, sf).select("wdid", fn.reconcile_min(a, b).alias("length"))


@query
def scaled_rate(spark, sf):
    both = roles.new_spills(spark, sf).unionByName(roles.old_spills(spark, sf))
    counts = picks.count_by(both, ["wdid"])
    joined = joins.attach(counts, roles.questionnaire(spark, sf), "wdid", ["length"])
    rate = fn.scaled_rate(F.col("spill_count") / 12, F.col("length"))
    return joined.select("wdid", "length", rate.alias("rate"))


@query
def exclude_pattern(spark, sf):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    orders = read(spark, sf, "orders").select("o_orderkey", priority.alias("location"))
    return orders.where(fn.not_matching(F.col("location"), "low"))


def _memberships(spark, sf):
    t = roles.tables(spark, sf)
    out = t["facilities"].select("wdid")
    for name, table in (
        ("in_new", "new_spills"),
        ("in_old", "old_spills"),
        ("has_report", "annual_reports"),
        ("has_answer", "questionnaire"),
        ("has_month", "monthly_counts"),
        ("has_order", "enforcement"),
    ):
        out = joins.flag_in(out, t[table], "wdid", name)
    return out


@query
def membership_flags(spark, sf):
    flags = _memberships(spark, sf)
    total = sum((F.col(c).cast("int") for c in flags.columns[1:]), F.lit(0))
    return flags.withColumn("flags", total)


@query
def reason_code(spark, sf):
    args = (F.col("has_order"), ~F.col("has_month"), ~F.col("has_report"))
    return _memberships(spark, sf).select(
        "wdid", fn.reason(*args).alias("reason"), fn.criteria_met(*args).alias("criteria_met")
    )


@query
def report_layout(spark, sf):
    fac = roles.facilities(spark, sf)
    x = fac.select("wdid", F.col("facility_name").alias("facility_name_x"), "community_type")
    y = fac.select("wdid", F.col("facility_name").alias("facility_name_y"), "federal_facility")
    both = joins.left_join(x, y, "wdid").withColumn(
        "facility_name", F.coalesce("facility_name_x", "facility_name_y")
    )
    return layout.layout(both, ["wdid", "facility_name"], r"_x$|_y$")


# --- filters, joins, unions --------------------------------------------------


@query
def clean_spills_new(spark, sf):
    t = roles.tables(spark, sf)
    return facts.clean_feed(t["new_spills"], t["facilities"], CONFIG, CONFIG.new_types)


@query
def clean_spills_old(spark, sf):
    t = roles.tables(spark, sf)
    return facts.clean_feed(t["old_spills"], t["facilities"], CONFIG, CONFIG.old_types)


@query
def fanout_left_join(spark, sf):
    feeds = [
        joins.left_join(
            spilled.select("row_no", "wdid", "spill_date"),
            right.select("wdid", "length", F.col("row_no").alias("right_row")),
            "wdid",
            spread=True,
        )
        for spilled, right in _feeds(spark, sf)
    ]
    return picks.union_feeds(feeds, "feed")


@query
def weighted_fanout_count(spark, sf):
    feeds = [
        joins.fanout_count(
            spilled.withColumn("year", F.year("spill_date")), right, "wdid", ["wdid", "year"], "spill_count"
        )
        for spilled, right in _feeds(spark, sf)
    ]
    return picks.union_feeds(feeds, "feed")


@query
def semi_join_known(spark, sf):
    eligible = roles.facilities(spark, sf).where("cs_assessment = 'Yes'")
    feeds = [joins.keep_in(spilled, eligible, "wdid", spread=True) for spilled, _ in _feeds(spark, sf)]
    return picks.union_feeds(feeds, "feed").select("feed", "row_no", "wdid", "spill_date")


@query
def anti_join_missing_report(spark, sf):
    t = roles.tables(spark, sf)
    return reporting.missing_report(t["facilities"], t["annual_reports"])


@query
def full_join_sources(spark, sf):
    return _first_lengths(spark, sf)


@query
def attach_attributes(spark, sf):
    t = roles.tables(spark, sf)
    both = t["new_spills"].unionByName(t["old_spills"])
    counts = picks.count_by(both.withColumn("year", F.year("spill_date")), ["wdid", "year"])
    attrs = system_attributes(t, CONFIG)
    return joins.attach(counts, attrs, "wdid", ["length", "length_class", "population_class"])


@query
def union_feeds(spark, sf):
    feeds = [roles.new_spills(spark, sf), roles.old_spills(spark, sf)]
    return picks.union_feeds(feeds, "feed").select("feed", "row_no", "wdid", "spill_type")


# --- counts and picks --------------------------------------------------------


@query
def annual_counts(spark, sf):
    t = roles.tables(spark, sf)
    keys = ["wdid", "year"]
    feeds = []
    for feed, types, right in (
        ("new_spills", CONFIG.new_types, "annual_reports"),
        ("old_spills", CONFIG.old_types, "questionnaire"),
    ):
        scoped = t[feed].where(facts.in_scope(CONFIG, types)).withColumn("year", F.year("spill_date"))
        counts = joins.fanout_count(scoped, t[right], "wdid", keys, "spill_count")
        # Known assets are looked up per count, not per spill.
        feeds.append(joins.keep_in(counts, t["facilities"], "wdid"))
    return picks.union_feeds(feeds, "feed")


@query
def monthly_counts(spark, sf):
    return spills.month_counts(_weighted(spark, sf))


@query
def annual_counts_combined(spark, sf):
    return picks.sum_counts(annual_counts(spark, sf), ["wdid", "year"])


@query
def latest_per_system(spark, sf):
    orders = read(spark, sf, "orders")
    return picks.latest(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice"
    )


@query
def first_per_key(spark, sf):
    orders = read(spark, sf, "orders")
    return picks.first_row(orders, ["o_custkey", "o_orderstatus"], ["o_orderkey"]).select(
        "o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice"
    )


@query
def source_label(spark, sf):
    t = roles.tables(spark, sf)
    frames = [
        ("Reports", t["annual_reports"]),
        ("Months", t["monthly_counts"]),
        ("Orders", t["enforcement"]),
    ]
    return picks.label_sources(frames, ["wdid"])


# --- panels and rates --------------------------------------------------------


@query
def dense_year_panel(spark, sf):
    counts = spills.yearly_counts(_weighted(spark, sf))
    return panels.densify_global(counts, spills.PANEL_KEYS, "year", "spill_count")


@query
def dense_month_panel(spark, sf):
    counts = spills.month_counts(_weighted(spark, sf))
    return panels.densify_span(
        counts, ["wdid", "length"], "month", "spill_count", extra=["length_class"]
    )


@query
def fill_down_up(spark, sf):
    counts = spills.yearly_counts(_weighted(spark, sf))
    panel = panels.densify_global(counts, ["wdid"], "year", "spill_count")
    reports = picks.first_row(
        roles.annual_reports(spark, sf), ["wdid", "report_year"], ["row_no"]
    ).select("wdid", F.col("report_year").alias("year"), F.col("length").alias("report_length"))
    reported = joins.left_join(panel, reports, ["wdid", "year"])
    return panels.fill_down_up(reported, ["wdid"], "year", ["report_length"])


@query
def rolling_5yr(spark, sf):
    counts = spills.yearly_counts(_weighted(spark, sf))
    return spills.rates_5yr(counts, CONFIG).drop("rate")


@query
def rolling_12mo(spark, sf):
    counts = spills.month_counts(_weighted(spark, sf))
    dense = panels.densify_span(counts, ["wdid", "length"], "month", "spill_count")
    return panels.rolling_mean(dense, ["wdid", "length"], "month", "spill_count", 12, "rolling_avg")


@query
def class_quartiles(spark, sf):
    rates = _rates_5yr(spark, sf).where("in_baseline")
    return quantiles.quartiles(rates, "length_class", "rate")


@query
def band_5yr(spark, sf):
    return spills.banded(_rates_5yr(spark, sf))


@query
def band_12mo(spark, sf):
    return spills.banded(_rates_12mo(spark, sf))


def _low_both(b):
    rows = job.bands(b, CONFIG, _kept, outliers=False)
    return spills.low_both(
        spills.of_window(rows, spills.FIVE_YEARS), spills.of_window(rows, spills.TWELVE_MONTHS)
    )


@query
def low_in_both_windows(spark, sf):
    return _low_both(_base(spark, sf))


@query
def low_performer_list(spark, sf):
    low = spills.not_exempt(_low_both(_base(spark, sf)), CONFIG)
    return spills.described(low, roles.facilities(spark, sf))


@query
def absolute_limit_exemption(spark, sf):
    return spills.exempt(
        _low_both(_base(spark, sf)), CONFIG.limit_classes, CONFIG.limit_5yr, CONFIG.limit_12mo
    )


# --- outlier test ------------------------------------------------------------


def _baseline(spark, sf):
    return _rates_5yr(spark, sf).where("in_baseline").select("wdid", "year", "length_class", "rate")


@query
def gesd_candidates(spark, sf):
    return outliers.extreme_candidates(_baseline(spark, sf), "length_class", "rate")


@query
def extreme_deviate_step1(spark, sf):
    return outliers.max_deviate(_baseline(spark, sf), "length_class", "rate")


@query
def gesd_outliers(spark, sf):
    return outliers.gesd(_baseline(spark, sf), "length_class", "rate", ["wdid", "year"])


# --- reporting and enforcement -----------------------------------------------


@query
def nonreporting_entities(spark, sf):
    start, end = CONFIG.window("baseline")
    return reporting.silent(roles.monthly_counts(spark, sf), "wdid", start, end, closed=True)


def _certificates(spark, sf):
    t = roles.tables(spark, sf)
    known = facts.systems(t["facilities"])
    ids = reporting.uncertified_ids(reporting.month_facts(t["monthly_counts"], CONFIG), known)
    return reporting.missing_certificate(t["facilities"], ids)


@query
def reporting_gap_certificates(spark, sf):
    return _certificates(spark, sf)


def _gaps(spark, sf):
    return reporting.both_gaps(anti_join_missing_report(spark, sf), _certificates(spark, sf))


@query
def reporting_gap_both(spark, sf):
    return reporting.with_attributes(_gaps(spark, sf), _base(spark, sf).facts)


@query
def reports_filed_by(spark, sf):
    _, end = CONFIG.window("analysis")
    return reporting.filed_by(roles.annual_reports(spark, sf), end).select("wdid", "row_no", "updated")


@query
def active_orders(spark, sf):
    t = roles.tables(spark, sf)
    return enforcement.active_orders(t["enforcement"], t["facilities"], CONFIG)


@query
def enforcement_summary(spark, sf):
    orders = active_orders(spark, sf)
    return enforcement.order_summary(orders, "wdid", CONFIG.order_sequence)


@query
def spill_summary(spark, sf):
    return report.spill_summary(_weighted(spark, sf))


# --- composites --------------------------------------------------------------


@query
def system_attributes_query(spark, sf):
    return system_attributes(roles.tables(spark, sf), CONFIG)


QUERIES["system_attributes"] = QUERIES.pop("system_attributes_query")


def _listed(spark, sf, b):
    t = roles.tables(spark, sf)
    low = spills.not_exempt(_low_both(b), CONFIG)
    return report.combine(low, _gaps(spark, sf), t["facilities"], facts.systems(t["facilities"]))


@query
def inadequacy_list(spark, sf):
    return _listed(spark, sf, _base(spark, sf))


@query
def under_enforcement(spark, sf):
    b = _base(spark, sf)
    return enforcement.under_enforcement(
        active_orders(spark, sf), attributes_of(b.facts), _listed(spark, sf, b)
    )


@query
def system_report(spark, sf):
    return job.system_report(roles.tables(spark, sf), CONFIG)


@query
def summary_stats(spark, sf):
    return job.screen(roles.tables(spark, sf), CONFIG).summary
