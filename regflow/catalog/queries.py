"""One query per operator, each over the whole star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regflow.catalog import adapter as a
from regflow.functions import dates, numbers, text
from regflow.operators import archive, conform, coverage, curate, load, logs, migrate
from regflow.plans import migration, monthly, tables
from regflow.schema import GRAINS, LABEL_HEADER, OEM, RTO, STATE, TOTAL_HEADER, Grain
from regflow.session import work_path
from regflow.sources import dimensions, reports, staging

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def per_grain(*grains: Grain):
    """Register `name_<grain>` for each grain."""

    def register(function):
        for grain in grains:
            name = f"{function.__name__.rstrip('_')}_{grain.name}"
            QUERIES[name] = partial(function, grain=grain)
        return function

    return register


every_grain = per_grain(*GRAINS.values())


def as_of():
    return F.to_date(F.lit(a.AS_OF))


def districts_for(spark, sf, grain):
    return a.districts(spark, sf) if grain is RTO else None


# Sources and sinks


@every_grain
def discover(spark, sf, grain):
    found = a.raw_reports(spark, sf, grain).select("path").distinct()
    return reports.path_dimensions(found, grain)


@query
def valid_workbooks(spark, sf):
    return reports.with_validity(a.workbooks(spark, sf)).select("path", "valid")


@query
def read_workbooks(spark, sf):
    # The reader checks each file itself, so the bytes cross to Python once.
    read = reports.read_workbooks(a.workbooks(spark, sf, damaged=False), empty_cells=False)
    rows = conform.skip_empty_reports(read)
    return reports.widen(rows, a.RAW_HEADERS)


@query
def mapping_dim(spark, sf):
    return dimensions.mapping_rows(a.mapping_workbook(spark, sf))


@query
def mapping_dim_normalized(spark, sf):
    return dimensions.normalized_mapping(a.whole_mapping(spark, sf))


@query
def office_map_scan(spark, sf):
    # One JSON document per office; states of the last region come with an empty list.
    labels = F.when(F.col("n_regionkey") == 4, F.array().cast("array<string>")).otherwise(
        F.array("office_label")
    )
    documents = a.offices(spark, sf).select(
        F.to_json(F.create_map(F.col("state"), labels)).alias("value")
    )
    return dimensions.explode_office_maps(documents)


@query
def csv_stage_scan(spark, sf):
    path = work_path(spark, "csv")
    a.table(spark, sf, "documents").write.options(**staging.CSV_WRITE).csv(path)
    return staging.read_csv_stage(spark, path)


@query
def csv_ranges_scan(spark, sf):
    # Ranges much smaller than a file, many of which begin inside a text with line breaks.
    path = work_path(spark, "csv")
    lined = F.replace("text", F.lit(". "), F.lit('."\n'))
    pages = a.table(spark, sf, "documents").select("doc_id", lined.alias("text"), "lang")
    pages.write.options(**staging.CSV_WRITE).csv(path)
    return staging.read_csv_stage(spark, path, columns=["doc_id", "text", "lang"], split=1 << 18)


@query
def csv_monthly_sink(spark, sf):
    path = work_path(spark, "csv")
    frame = a.preprocessed(spark, sf, RTO, "min")
    staging.write_monthly_csvs(frame, path, RTO)
    return staging.read_csv_stage(spark, path, columns=RTO.columns)


@query
def stage_load(spark, sf):
    rescraped = a.preprocessed(spark, sf, RTO, "min")
    return load.stage_load(rescraped, RTO.columns).drop("inserted_at")


@query
def archive_manifest(spark, sf):
    paths = a.raw_reports(spark, sf, RTO).select("path").distinct()
    copy = F.replace("path", F.lit(".xlsx"), F.lit(" (1).xlsx"))
    both = paths.select(F.explode(F.array("path", copy)).alias("path"))
    return archive.archive_manifest(both, a.report_root(RTO))


@query
def archive_csv_pick(spark, sf):
    day = F.col("l_shipdate").cast("date")
    ending = F.when(F.col("l_linestatus") == "O", F.lit(".csv")).otherwise(F.lit(".txt"))
    name = F.concat(
        F.concat_ws(
            "_",
            F.lit(RTO.csv_prefix),
            dates.month_of(day),
            F.date_format(day, "yyyy"),
            F.col("l_returnflag"),
        ),
        ending,
    )
    listed = a.table(spark, sf, "lineitem").select("l_suppkey", name.alias("name"))
    return archive.pick_csv(listed, F.lit(f"{RTO.csv_prefix}_JAN_1996"), "l_suppkey")


@query
def archive_history_grid(spark, sf):
    paths = a.raw_reports(spark, sf, RTO).select("path").distinct()
    return archive.history_manifest(paths, a.report_root(RTO), 1996, 2000)


# Projections and filters


@query
def tag_metadata(spark, sf):
    return conform.tag_metadata(
        a.raw_reports(spark, sf, RTO).select("path", LABEL_HEADER, TOTAL_HEADER), RTO
    )


def _enriched(spark, sf, grain):
    tagged = conform.tag_metadata(a.raw_reports(spark, sf, grain), grain)
    return conform.enrich_class(tagged, a.mapping(spark, sf), grain)


@every_grain
def rename_project(spark, sf, grain):
    return conform.rename_project(_enriched(spark, sf, grain), grain)


@query
def fill_missing_columns(spark, sf):
    present = conform.rename_project(_enriched(spark, sf, STATE), STATE)
    return conform.fill_missing_columns(present, STATE.columns)


@query
def unexpected_columns(spark, sf):
    return conform.unexpected_columns(a.sheet_rows(spark, sf, OEM), OEM)


@query
def header_drift(spark, sf):
    return conform.header_drift(a.sheet_rows(spark, sf, OEM), OEM)


@query
def default_dimensions(spark, sf):
    columns = ["path", LABEL_HEADER, *conform.CLASS_HEADERS]
    return conform.default_dimensions(_enriched(spark, sf, STATE).select(columns))


@query
def normalize_state(spark, sf):
    tagged = conform.tag_metadata(a.raw_reports(spark, sf, STATE), STATE)
    return conform.normalize_state(tagged.select("path", LABEL_HEADER, "State"))


@query
def filter_states(spark, sf):
    tagged = conform.tag_metadata(a.raw_reports(spark, sf, RTO), RTO)
    chosen = conform.filter_states(tagged, ["Delhi", "Goa", "Kerala"])
    return chosen.select("path", LABEL_HEADER, "State")


@query
def skip_empty_reports(spark, sf):
    rows = conform.skip_empty_reports(a.sheet_rows(spark, sf, OEM))
    return rows.select("path", "row_no")


@every_grain
def curate_(spark, sf, grain):
    fact = a.fact(spark, sf, grain)
    return curate.curate(fact, grain, districts_for(spark, sf, grain)).drop("inserted_at")


@every_grain
def quarantine(spark, sf, grain):
    """Facts whose total or day does not parse, with the names of the columns."""
    fact = a.fact(spark, sf, grain)
    total = F.when(F.col("petrol").isNull(), F.concat("total", F.lit(".0"))).otherwise(F.col("total"))
    day = F.when(F.col("diesel").isNull(), F.lit("1st")).otherwise(F.col("day"))
    _, bad = curate.quarantine(fact.withColumns({"total": total, "day": day}))
    faults = F.array_join("bad_columns", ",").alias("faults")
    return bad.select(*grain.load_key, "day", "total", faults)


@query
def incremental_window(spark, sf):
    return curate.incremental_window(a.fact(spark, sf, RTO), as_of()).drop("inserted_at")


@query
def project_if_exists(spark, sf):
    return migrate.project_if_exists(a.legacy(spark, sf, OEM), OEM).drop("inserted_at")


@query
def first_existing_timestamp(spark, sf):
    older = a.legacy(spark, sf, STATE)
    stamp = migrate.first_existing_timestamp(older).alias("inserted_at")
    return older.select(*STATE.load_key, stamp)


@query
def null_repair(spark, sf):
    fact = a.fact(spark, sf, STATE).drop("inserted_at")
    return migrate.null_repair(fact, a.legacy(spark, sf, STATE))


@per_grain(RTO, OEM)
def null_repair_(spark, sf, grain):
    fact = a.fact(spark, sf, grain).drop("inserted_at")
    return migrate.null_repair(fact, a.legacy(spark, sf, grain))


@query
def history_defaults(spark, sf):
    return conform.history_defaults(_legacy_rows(spark, sf), monthly.LEGACY_HEADERS).drop("title")


def _legacy_rows(spark, sf):
    """Legacy sheet rows: no hybrid columns, and a total further left before 1998."""
    raw = a.raw_reports(spark, sf, STATE)
    tagged = conform.tag_metadata(raw, STATE)
    year = F.col("Year")
    total = F.when(year < "1998", F.lit("Unnamed: 23")).otherwise(F.lit("Unnamed: 26"))
    known = [LABEL_HEADER, "DIESEL", "PETROL", "PURE EV", "ELECTRIC(BOV)", "CNG ONLY"]
    pairs = ", ".join(f"'{h}', `{h}`" for h in known)
    cells = F.map_concat(F.expr(f"map({pairs})"), F.create_map(total, F.col(TOTAL_HEADER)))
    # The title carries the label, not the folder spelling.
    state = F.replace("State", F.lit("   "), F.lit(" & "))
    title = F.concat(
        F.lit("Vehicle Class Wise Fuel Data  of "), state, F.lit(" ("),
        F.col("Month"), F.lit(","), year, F.lit(")"),
    )
    return tagged.select("path", title.alias("title"), F.lit(0).alias("row_no"), cells.alias("cells"))


# Joins


@every_grain
def enrich_class(spark, sf, grain):
    wanted = ["path", LABEL_HEADER, grain.class_header, *conform.CLASS_HEADERS]
    return _enriched(spark, sf, grain).select(*dict.fromkeys(wanted))


@query
def join_district(spark, sf):
    joined = curate.join_district(a.fact(spark, sf, RTO), a.districts(spark, sf))
    return joined.select(*RTO.load_key, "district", "total")


@every_grain
def delete_staged(spark, sf, grain):
    kept = load.delete_staged(a.fact(spark, sf, grain), a.stage(spark, sf, grain), grain)
    return kept.drop("inserted_at")


@every_grain
def upsert_fact(spark, sf, grain):
    merged = load.upsert_fact(a.fact(spark, sf, grain), a.stage(spark, sf, grain), grain)
    return merged.drop("inserted_at")


@every_grain
def curated_upsert(spark, sf, grain):
    lookup = districts_for(spark, sf, grain)
    current = curate.curate(a.fact(spark, sf, grain), grain, lookup)
    window = curate.incremental_window(a.stage(spark, sf, grain), as_of())
    fresh = curate.curate(window, grain, lookup)
    return curate.upsert_curated(current, fresh, grain).drop("inserted_at")


@every_grain
def curated_counted(spark, sf, grain):
    """The same as `curated_upsert`, with the number of rows that share a unique key."""
    lookup = districts_for(spark, sf, grain)
    current = curate.curate(a.fact(spark, sf, grain), grain, lookup)
    window = curate.incremental_window(a.stage(spark, sf, grain), as_of())
    fresh = curate.curate(window, grain, lookup)
    return curate.merge_counted(current, fresh, grain).select(*grain.curated_key, "total", "copies")


@every_grain
def backfill_electric(spark, sf, grain):
    filled = migrate.backfill_electric(
        a.backfill_target(spark, sf, grain), a.legacy_with_copies(spark, sf, grain), grain
    )
    return filled.select(*grain.backfill_key, "electric_bov", "backfilled")


def _expected(spark, sf, grain):
    states = coverage.state_list(spark)
    months = a.month_list(spark, sf)
    root = a.report_root(grain)
    if grain is STATE:
        return coverage.expected_grid_state(states, months, grain, root)
    if grain is OEM:
        return coverage.expected_grid_oem(states, a.class_list(spark, sf), months, grain, root)
    listed = a.offices(spark, sf).select("state", "office_label")
    return coverage.expected_grid_rto(states, listed, months, grain, root)


@query
def expected_grid_oem(spark, sf):
    return _expected(spark, sf, OEM)


@query
def expected_grid_rto(spark, sf):
    return _expected(spark, sf, RTO)


@every_grain
def missing_reports(spark, sf, grain):
    missing = coverage.missing_reports(_expected(spark, sf, grain), a.files(spark, sf, grain))
    return missing.select("path", "state", "month", "year")


@query
def merge_office_map(spark, sf):
    listed = a.offices(spark, sf)
    older = F.concat(F.lit("OLD "), "office_label").alias("office_label")
    previous = listed.filter("n_regionkey >= 1").select("state", older)
    fresh = listed.filter("n_regionkey <= 2").select("state", "office_label")
    return coverage.merge_office_maps(previous, fresh)


@query
def states_without_offices(spark, sf):
    return coverage.states_without_offices(coverage.state_list(spark), a.offices(spark, sf))


@query
def redownload_plan(spark, sf):
    plan = coverage.redownload_plan(_expected(spark, sf, RTO), a.files(spark, sf, RTO))
    return plan.select("state", "office_label", "month", "year", "action")


@query
def redownload_plan_force(spark, sf):
    plan = coverage.redownload_plan(_expected(spark, sf, RTO), a.files(spark, sf, RTO), force=True)
    return plan.select("state", "office_label", "month", "year", "action")


# Aggregations


@query
def reconcile_counts(spark, sf):
    tables = {}
    for grain in GRAINS.values():
        tables[f"{grain.fact_table}_backup"] = a.legacy(spark, sf, grain)
        tables[grain.fact_table] = a.fact(spark, sf, grain)
    return migrate.reconcile_counts(tables)


@query
def repair_check(spark, sf):
    tables = {g.fact_table: a.fact(spark, sf, g) for g in GRAINS.values()}
    repaired = {
        f"{g.fact_table}_repaired": migrate.null_repair(tables[g.fact_table], a.legacy(spark, sf, g))
        for g in GRAINS.values()
    }
    return migrate.repair_check(tables | repaired)


@query
def backfill_counts(spark, sf):
    return migrate.backfill_counts(
        {
            g.fact_table: migrate.backfill_electric(
                a.backfill_target(spark, sf, g), a.legacy_with_copies(spark, sf, g), g
            )
            for g in GRAINS.values()
        }
    )


@query
def backfill_dates(spark, sf):
    return migrate.backfill_dates(a.legacy_with_copies(spark, sf, STATE))


@query
def coverage_summary(spark, sf):
    return coverage.coverage_summary(_expected(spark, sf, RTO), a.files(spark, sf, RTO))


@query
def preprocess_summary(spark, sf):
    rows = reports.path_dimensions(a.sheet_rows(spark, sf, OEM), OEM)
    return conform.preprocess_summary(rows, ["State", "Year"])


# Sequences, stacking and copies


@query
def month_windows(spark, sf):
    day = F.col("l_shipdate").cast("date")
    ranges = (
        a.table(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    )
    windows = coverage.month_windows(ranges, "first_day", "last_day")
    return windows.select("l_suppkey", "month", "year")


@query
def union_reports(spark, sf):
    raw = a.raw_reports(spark, sf, STATE)
    year = reports.path_piece(F.col("path"), 3)
    early = raw.filter(year < "2000").drop(a.NEW_HEADER)
    late = raw.filter(year >= "2000").drop("STRONG HYBRID EV")
    return conform.union_reports(early, late)


@query
def flagged_tail(spark, sf):
    line = F.concat_ws(" ", "event_type", "props", F.concat(F.lit("#"), "event_id"))
    lines = a.table(spark, sf, "events").select(
        "user_id", F.col("ts").cast("date").alias("day"), "ts", "event_id",
        line.alias("line"), "event_type",
    )
    return logs.flagged_tail(
        lines, ["user_id", "day"], ["ts", "event_id"],
        flagged=F.col("event_type") == "error", max_lines=2, max_chars=40,
    )


@query
def snapshot_backup(spark, sf):
    path = work_path(spark, "backup")
    return migrate.snapshot_backup(a.fact(spark, sf, STATE), path).drop("inserted_at")


@query
def resume_from_backup(spark, sf):
    path = work_path(spark, "backup")
    migrate.snapshot_backup(a.legacy(spark, sf, OEM), path)
    return migration.resume_from_backup(spark, OEM, path).fact.drop("inserted_at")


# Scalar functions


def _order_day(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return a.table(spark, sf, "orders").withColumn("day", day)


@query
def fn_convert_date(spark, sf):
    day = F.col("day")
    written = F.concat_ws("/", F.lit("1"), dates.month_of(day), F.date_format(day, "yyyy"))
    frame = _order_day(spark, sf).select("o_orderkey", written.alias("written"))
    return frame.withColumn("converted", dates.report_date_text(F.col("written")))


@query
def fn_month_number(spark, sf):
    label = dates.month_of(F.col("day"))
    # Only upper case is known.
    shown = F.when(F.col("o_orderstatus") == "P", F.lower(label)).otherwise(label)
    frame = _order_day(spark, sf).select("o_orderkey", shown.alias("label"))
    frame = frame.withColumn("number", dates.month_number(F.col("label")))
    return frame.withColumn("name", dates.month_name(F.col("number")))


@query
def fn_remove_special(spark, sf):
    return a.table(spark, sf, "documents").select(
        "doc_id", text.remove_special(F.col("text")).alias("cleaned")
    )


@query
def fn_state_folder(spark, sf):
    named = a.offices(spark, sf).select(
        "s_suppkey", text.state_folder(F.col("state")).alias("folder")
    )
    urls = a.table(spark, sf, "pages").select(
        F.col("page_id").alias("s_suppkey"), text.state_folder(F.col("url")).alias("folder")
    )
    return named.unionByName(urls)


@query
def fn_office_name_code(spark, sf):
    label = F.col("office_label")
    return a.offices(spark, sf).select(
        "office_label", text.office_folder(label).alias("folder"),
        text.office_code(label).alias("code"),
    )


@query
def fn_split_office_folder(spark, sf):
    folder = F.col("folder")
    return a.offices(spark, sf).select(
        "folder", text.office_folder_name(folder).alias("rto_name"),
        text.office_folder_code(folder).alias("rto_code"),
    )


@query
def fn_label_match(spark, sf):
    # The equality finds the one candidate; the text rule confirms it.
    listed = a.offices(spark, sf)
    labels = listed.select("office_label", text.office_code(F.col("office_label")).alias("found"))
    codes = listed.select(F.concat(F.lit("R"), "s_suppkey").alias("code"))
    same = (F.col("code") == F.col("found")) & text.label_has_code(
        F.col("office_label"), F.col("code")
    )
    return codes.join(labels, same).select("code", "office_label")


@query
def fn_report_path(spark, sf):
    listed = a.offices(spark, sf)
    first = (
        a.table(spark, sf, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.min(F.col("l_shipdate").cast("date")).alias("day"))
    )
    joined = listed.join(first, F.col("s_suppkey") == F.col("l_suppkey"))
    year, month = F.date_format("day", "yyyy"), dates.month_of(F.col("day"))
    state, label = F.col("state"), F.col("office_label")

    def path(grain, member=None):
        return text.report_path(grain, a.report_root(grain), state, year, month, member)

    return joined.select(
        "s_suppkey", path(STATE).alias("state_path"), path(RTO, label).alias("rto_path"),
        path(OEM, label).alias("oem_path"),
    )


@query
def fn_parse_count(spark, sf):
    written = F.format_number(F.floor("l_extendedprice"), 0)
    frame = a.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", written.alias("written")
    )
    return frame.withColumn("value", numbers.parse_count(F.col("written")))


@query
def fn_parse_date_103(spark, sf):
    day = F.col("day")
    written = F.concat_ws("/", F.dayofmonth(day), F.month(day), F.year(day))
    frame = _order_day(spark, sf).select("o_orderkey", written.alias("written"))
    return frame.withColumn("value", dates.report_date(F.col("written")))


@query
def fn_varchar(spark, sf):
    # The cut to a declared width is the function itself.
    body = F.col("text")
    return a.table(spark, sf, "documents").select(
        "doc_id", text.varchar(body, 100).alias("wide"), text.varchar(body, 50).alias("narrow")
    )


@query
def fn_blank_to_null(spark, sf):
    kind = F.col("event_type")
    padded = F.when(kind == "click", F.lit("   ")).otherwise(F.concat(F.lit("  "), kind, F.lit(" ")))
    return a.table(spark, sf, "events").select("event_id", text.blank_to_null(padded).alias("value"))


@query
def fn_previous_month(spark, sf):
    before = dates.previous_month_start(F.col("day"))
    return _order_day(spark, sf).select(
        "o_orderkey", dates.month_of(before).alias("month"),
        F.date_format(before, "yyyy").alias("year"),
    )


@query
def fn_month_label(spark, sf):
    typed = F.concat(F.lit(" "), F.lower(dates.month_of(F.col("day"))), F.lit("\t"))
    return _order_day(spark, sf).select("o_orderkey", dates.month_label(typed).alias("label"))


@query
def fn_history_title(spark, sf):
    day = F.col("day")
    good = F.concat(
        F.lit("x Vehicle Class Wise Fuel Data  of "), F.col("state"), F.lit("  ("),
        dates.month_of(day), F.lit(","), F.date_format(day, "yyyy"), F.lit(")"),
    )
    title = F.when(F.col("o_orderstatus") == "P", F.lit("Fuel Data")).otherwise(good)
    frame = (
        _order_day(spark, sf)
        .join(a.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderstatus", "day", a.state_of(F.col("c_nationkey")).alias("state"))
    )
    title_of = F.col("title")
    return frame.select("o_orderkey", title.alias("title")).select(
        "o_orderkey",
        text.history_title(title_of, "state").alias("state"),
        text.history_title(title_of, "month").alias("month"),
        text.history_title(title_of, "year").alias("year"),
    )


@query
def fn_context_text(spark, sf):
    kind = F.col("event_type")
    context = F.create_map(
        F.lit("user"), F.col("user_id").cast("string"),
        F.lit("event"), F.when(kind != "view", kind),
        F.lit("props"), F.when(kind == "click", F.lit("")).otherwise(F.col("props")),
    )
    return a.table(spark, sf, "events").select("event_id", text.context_text(context).alias("value"))


@query
def fn_artifact_label(spark, sf):
    return a.table(spark, sf, "pages").select(
        "page_id", text.artifact_label(F.col("url")).alias("label"),
        text.artifact_label(F.col("html"), 200).alias("html_label"),
    )


@query
def fn_first_message_line(spark, sf):
    message = F.concat(F.lit("Message: \n # frame\n"), F.col("text"))
    return a.table(spark, sf, "documents").select(
        "doc_id", text.first_message_line(F.col("source"), message).alias("summary")
    )


@query
def blocked_pages(spark, sf):
    title = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    checked = logs.blocked_pages(
        a.table(spark, sf, "pages"), title, a.BLOCKED_TITLE, a.BLOCKED_MARKERS
    )
    return checked.select("page_id", "blocked_reason")


# Whole jobs


@every_grain
def preprocess(spark, sf, grain):
    return a.preprocessed(spark, sf, grain)


@query
def preprocess_rows_oem(spark, sf):
    # Through sheet rows, with an empty report for many classes and months.
    return monthly.preprocess_rows(a.sheet_rows(spark, sf, OEM), a.mapping(spark, sf), OEM)


@query
def preprocess_workbooks_rto(spark, sf):
    # Through workbooks and their reader.
    rows = reports.read_workbooks(a.workbooks(spark, sf, damaged=False), empty_cells=False)
    return monthly.preprocess_rows(rows, a.mapping(spark, sf), RTO)


@every_grain
def monthly_run(spark, sf, grain):
    """A month loaded into stored tables that hold all months before."""
    facts, curated = work_path(spark, "fact"), work_path(spark, "curated")
    lookup = districts_for(spark, sf, grain)
    load.load_fact(facts, a.fact(spark, sf, grain), grain)
    if grain is not STATE:
        tables.refresh_curated(spark, facts, curated, grain, as_of(), lookup, full=True)
    latest = a.preprocessed(spark, sf, grain, "min", "2001-10-01")
    load.load_fact(facts, load.stage_load(latest, grain.columns), grain)
    if grain is STATE:
        return load.read_fact(spark, facts, grain).drop("inserted_at", load.PERIOD)
    tables.refresh_curated(spark, facts, curated, grain, as_of(), lookup)
    return tables.read_curated(spark, curated, grain).drop("inserted_at")


@query
def history_backfill(spark, sf):
    rescraped = a.raw_reports(spark, sf, RTO, "min", "1996-03-01", "1999-09-01")
    merged = monthly.history_backfill(
        rescraped, a.mapping(spark, sf), a.fact(spark, sf, RTO), RTO,
        ["Maharashtra"], F.lit("1996-03-01").cast("date"), F.lit("1999-08-01").cast("date"),
    )
    return merged.drop("inserted_at")


@every_grain
def schema_migration(spark, sf, grain):
    path = work_path(spark, f"backup-{grain.name}")
    result = migration.migrate_schema(a.legacy(spark, sf, grain), grain, path)
    return result.fact.drop("inserted_at")


@every_grain
def stored_migration(spark, sf, grain):
    """A stored table migrated by way of its backup, a count and a switch."""
    path = work_path(spark, f"legacy-{grain.name}")
    a.legacy(spark, sf, grain).write.parquet(path)
    migration.migrate_table(spark, path, grain, work_path(spark, f"backup-{grain.name}"))
    return load.read_fact(spark, path, grain).drop("inserted_at", load.PERIOD)


@every_grain
def stored_backfill(spark, sf, grain):
    """A stored table of which only the periods that change are written."""
    path, backup = work_path(spark, "fact"), work_path(spark, "backup")
    target = a.backfill_target(spark, sf, grain).withColumn("inserted_at", F.current_timestamp())
    load.load_fact(path, target, grain)
    a.legacy_with_copies(spark, sf, grain).write.parquet(backup)
    migration.backfill_table(spark, path, grain, backup)
    return load.read_fact(spark, path, grain).select(*grain.backfill_key, "electric_bov")


@every_grain
def stored_repair(spark, sf, grain):
    path, backup = work_path(spark, "fact"), work_path(spark, "backup")
    load.load_fact(path, a.fact(spark, sf, grain), grain)
    a.legacy(spark, sf, grain).write.parquet(backup)
    migration.repair_table(spark, path, grain, backup)
    return load.read_fact(spark, path, grain).drop("inserted_at", load.PERIOD)


@query
def history_state_preprocess(spark, sf):
    return monthly.history_state_preprocess(_legacy_rows(spark, sf), a.mapping(spark, sf))


@query
def full_refresh_rto(spark, sf):
    fact = a.fact(spark, sf, RTO)
    return monthly.full_refresh(fact, RTO, a.districts(spark, sf)).drop("inserted_at")
