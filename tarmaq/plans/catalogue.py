"""Every operator of the flight model as a named query over a folder of benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmaq.functions.typing import decimal_comma
from tarmaq.operators import audit, lookup, quality
from tarmaq.operators.dedup import first_per_key, repeated_keys
from tarmaq.plans import bronze, consumption, contract, gold, increment, silver
from tarmaq.plans import vocabulary as V
from tarmaq.plans.fixtures import Flights
from tarmaq.session import shared_folder
from tarmaq.sources.arrived import Load, load_new_files
from tarmaq.sources.clustered import write_clustered
from tarmaq.sources.delimited import (
    NO_QUOTES,
    REASON,
    REJECTED_LINE,
    SOURCE_FILE,
    accepted,
    read_delimited,
    read_marked,
    rejects,
    require_headers,
    write_delimited,
)
from tarmaq.sources.footers import footer_counts
from tarmaq.sources.months import read_parts, replace_parts
from tarmaq.sources.snapshots import load_history, read_snapshot, write_snapshot

Query = Callable[[Flights], DataFrame]

QUERIES: dict[str, Query] = {}

CLOCK_COLUMNS = ["_ingerido_em", silver.TYPED_AT, gold.PROCESSED_AT, V.QUARANTINED_AT]


def query(build: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[build.__name__] = build
    return build


def timeless(df: DataFrame) -> DataFrame:
    """Without the columns that hold the time of the run."""
    return df.drop(*CLOCK_COLUMNS)


def rounded_means(df: DataFrame) -> DataFrame:
    """Means rounded to six digits: engines differ in the last bit of a quotient."""
    means = [name for name in df.columns if name.startswith("avg_")]
    return df.withColumns({name: F.round(name, 6) for name in means})


# Raw tables and typing


@query
def delimited_round_trip(f: Flights) -> DataFrame:
    """Customers written as text files with preamble and header, then scanned with their files."""
    path = f"{shared_folder(f.spark)}/tarmaq/text-{uuid4().hex}"
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    write_delimited(f.table("customer").select(*columns), path, F.col("c_custkey") % 7,
                    "Atualizado em: 2025-08-01")
    files = f"{path}/file=*/*.txt"
    require_headers(f.spark, files, columns)
    folder = F.regexp_extract("_metadata.file_path", r"file=(\d+)/", 1)
    return read_delimited(f.spark, files, columns).select("*", folder.alias("from_file"))


@query
def latin1_round_trip(f: Flights) -> DataFrame:
    """Documents with quotation marks written in Latin-1 and scanned with quoting off."""
    path = f"{shared_folder(f.spark)}/tarmaq/latin-{uuid4().hex}"
    flat = F.regexp_replace("text", r"[;\s]+", " ")
    spelt = F.trim(F.regexp_replace(flat, r"[^\x20-\x7E\xA1-\xFF]", "?"))
    quoted = F.concat(F.lit('"'), F.substring("lang", 1, 1), F.lit(" "), spelt)
    write_delimited(f.table("documents").select("doc_id", quoted.alias("text")), path,
                    F.col("doc_id") % 16, "preâmbulo", encoding="ISO-8859-1")
    back = read_delimited(f.spark, f"{path}/file=*/*.txt", ["doc_id", "text"],
                          encoding="ISO-8859-1", quote=NO_QUOTES)
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("chars"))


@query
def rejected_lines(f: Flights) -> DataFrame:
    """Customers of whom some lines are short, long or badly quoted: what is a row, what not."""
    path = f"{shared_folder(f.spark)}/tarmaq/damaged-{uuid4().hex}"
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    key, name, nation, segment = (F.col(c).cast("string") for c in columns)
    quote, kind = F.lit('"'), F.col("c_custkey") % 10

    def line(*parts):
        return F.concat_ws(";", *parts)

    damaged = (
        F.when(kind == 1, line(key, name, nation))
        .when(kind == 2, line(key, name, nation, segment, F.lit("more")))
        .when(kind == 3, line(key, F.concat(quote, name), nation, segment))
        .when(kind == 4, line(key, name, nation, F.concat(quote, segment)))
        .when(kind == 5, line(key, F.concat(quote, name, F.lit(";x"), quote), nation, segment))
        .otherwise(line(key, name, nation, segment)))
    write_delimited(f.table("customer").select(*columns), path, F.col("c_custkey") % 7,
                    "Atualizado em: 2025-08-01", line=damaged)
    marked = read_marked(f.spark, f"{path}/file=*/*.txt", columns)
    good, bad = accepted(marked), rejects(marked)
    return good.select("c_custkey", "c_name", F.lit(None).cast("string").alias("reason"),
                       F.lit(None).cast("string").alias("line")).unionByName(bad.select(
        F.regexp_extract(REJECTED_LINE, r"^(\d+)", 1).alias("c_custkey"),
        F.lit(None).cast("string").alias("c_name"), F.col(REASON).alias("reason"),
        F.col(REJECTED_LINE).alias("line")))


@query
def registry_scan(f: Flights) -> DataFrame:
    """Both company registries written as they are published, then scanned file by file."""
    path = f"{shared_folder(f.spark)}/tarmaq/registries-{uuid4().hex}"
    sides = {"national": f.national, "foreign": f.foreign}
    scans = []
    for file, (_, label) in bronze.COMPANY_FILES.items():
        published = sides[label].select(*[
            F.col(target).alias(source) for source, target in V.COMPANY_COLUMNS.items()])
        write_delimited(published, f"{path}/{file}", F.lit(0), "Atualizado em: 2025-08-01")
        scans.append(bronze.companies(f.spark, path, file))
    return timeless(scans[0].unionByName(scans[1]))


@query
def loads_of_new_files(f: Flights) -> DataFrame:
    """Three loads of one folder: five files, the same again, and two files more."""
    path = f"{shared_folder(f.spark)}/tarmaq/arrived-{uuid4().hex}"
    columns = ["c_custkey", "c_name"]
    file = F.col("c_custkey") % 7

    def deliver(part: str, chosen) -> None:
        write_delimited(f.table("customer").where(chosen).select(*columns), f"{path}/in/{part}",
                        file, "Atualizado em: 2025-08-01")

    def load(number: int) -> Load:
        return load_new_files(
            f.spark, f"{path}/in/*/file=*/*.txt", f"{path}/table", f"{path}/ledger", str(number),
            lambda files: read_delimited(f.spark, files, columns))

    deliver("a", file < 5)
    loads = [load(1), load(2)]
    deliver("b", file >= 5)
    loads.append(load(3))
    told = f.spark.createDataFrame([(int(x.load_id), x.files) for x in loads],
                                   "load_id int, files int")
    rows = f.spark.read.parquet(f"{path}/table").groupBy("load_id").agg(
        F.count("*").alias("rows"))
    return told.join(rows, "load_id", "left").select(
        "load_id", "files", F.coalesce("rows", F.lit(0)).alias("rows"))


@query
def counts_from_footers(f: Flights) -> DataFrame:
    """Rows of the given tables without reading one."""
    names = ["customer", "orders", "lineitem", "documents", "events"]
    return footer_counts(f.spark, {name: f"{f.folder}/{name}.parquet" for name in names})


@query
def audit_load_summary(f: Flights) -> DataFrame:
    return audit.load_summary(f.bronze, SOURCE_FILE, "Partida Prevista", "latest_departure")


@query
def seed_codes(f: Flights) -> DataFrame:
    """The seeded codes with their use, so that every catalogued code shows even if unused."""
    used = f.silver.groupBy("di_code", "line_type_code").agg(F.count("*").alias("rows"))
    steps = used.select(F.inline(F.array(*[
        F.struct(F.lit(domain).alias("domain"), F.col(domain).alias("code"), "rows")
        for domain in ("di_code", "line_type_code")
    ])))
    uses = steps.groupBy("domain", "code").agg(F.sum("rows").alias("flight_steps"))
    return f.codes.join(uses, ["domain", "code"], "left").select(
        "domain", "code", "description",
        F.coalesce("flight_steps", F.lit(0)).alias("flight_steps"))


@query
def missing_token_profile(f: Flights) -> DataFrame:
    moments = [source for source, target in V.FLIGHT_COLUMNS.items() if target in silver.MOMENTS]
    return quality.token_profile(f.bronze, moments, V.MISSING_MOMENT, ".")


@query
def typed_mirror(f: Flights) -> DataFrame:
    return timeless(f.derived_silver())


@query
def typing_completeness(f: Flights) -> DataFrame:
    return quality.completeness(f.silver, [*silver.MOMENTS, *silver.DELAYS])


@query
def decimal_comma_cast(f: Flights) -> DataFrame:
    return timeless(f.aerodromes)


@query
def decimal_comma_balances(f: Flights) -> DataFrame:
    """Balances written with a decimal comma, some unreadable, read back as numbers."""
    text = F.when(F.col("c_custkey") % 17 == 0, "N/D").otherwise(
        F.translate(F.col("c_acctbal").cast("string"), ".", ","))
    return f.table("customer").select("c_custkey", decimal_comma(text).alias("balance"))


@query
def conform_union(f: Flights) -> DataFrame:
    return timeless(f.airlines)


@query
def registry_key_coverage(f: Flights) -> DataFrame:
    return audit.key_coverage(f.airlines, "registry_origin", "icao")


@query
def key_filter_in_list(f: Flights) -> DataFrame:
    rows = consumption.registry_rows(f.airlines, "icao", ["A001", "A013", "A026", "A089"])
    return rows.select("icao", "legal_name", "status", "registry_origin")


@query
def segment_in_list(f: Flights) -> DataFrame:
    """The list filter on a native table, grouped."""
    chosen = f.table("customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return chosen.groupBy("c_mktsegment", "c_nationkey").agg(
        F.count("*").alias("customers"), F.max("c_acctbal").alias("highest_balance"))


@query
def first_departures(f: Flights) -> DataFrame:
    return consumption.first_departures(f.silver)


# Quality


@query
def membership_flags(f: Flights) -> DataFrame:
    flags = ["origem_no_cadastro", "destino_no_cadastro", "empresa_no_cadastro"]
    return f.marked.select(*gold.STEP_KEYS, SOURCE_FILE, *flags)


@query
def expectation_metrics(f: Flights) -> DataFrame:
    return quality.expectation_counts(f.marked, contract.flight_rules())


@query
def quarantine_rows(f: Flights) -> DataFrame:
    return timeless(contract.quarantined(f.marked))


@query
def violation_distribution(f: Flights) -> DataFrame:
    return quality.violation_distribution(f.marked, contract.flight_rules())


@query
def quarantine_share(f: Flights) -> DataFrame:
    return quality.quarantine_share(contract.quarantined(f.marked), f.silver)


@query
def reconcile_counts(f: Flights) -> DataFrame:
    pairs = {
        "flights": ([f.bronze], f.silver),
        "airlines": ([f.national, f.foreign], f.airlines),
        "aerodromes": ([f.bronze_aerodromes], f.aerodromes),
    }
    reports = [
        audit.reconcile(sources, target).select(F.lit(name).alias("table_name"), "*")
        for name, (sources, target) in pairs.items()
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query
def plausibility_mask(f: Flights) -> DataFrame:
    masked = gold.plausible_only(f.derived_silver())
    return masked.select(*gold.STEP_KEYS, SOURCE_FILE, "delay_out_of_range", *silver.DELAYS)


# Deduplication and lookups


@query
def dedup_exact(f: Flights) -> DataFrame:
    return timeless(gold.deduplicated(f.silver))


@query
def repeated_steps(f: Flights) -> DataFrame:
    return repeated_keys(f.silver, gold.STEP_KEYS)


@query
def best_row_by_priority(f: Flights) -> DataFrame:
    return gold.best_airlines(f.airlines)


@query
def first_row_per_key(f: Flights) -> DataFrame:
    return gold.first_aerodromes(f.aerodromes)


@query
def first_line_per_order(f: Flights) -> DataFrame:
    """The first shipped line of each order, by a total order over its lines."""
    lines = f.table("lineitem").select(
        "l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return first_per_key(lines, ["l_orderkey"], [
        "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])


@query
def code_lookup_fallback(f: Flights) -> DataFrame:
    described = gold.with_code_descriptions(f.silver, f.codes, {
        "di_code": "di_description", "line_type_code": "line_type_description"})
    return described.groupBy(
        "di_code", "di_description", "line_type_code", "line_type_description"
    ).agg(F.count("*").alias("flight_steps"))


@query
def union_distinct_codes(f: Flights) -> DataFrame:
    return gold.airport_codes(f.silver)


@query
def role_playing_nation(f: Flights) -> DataFrame:
    """Trade between the customer's nation and the supplier's, one nation table in two roles.

    Lines meet their orders, are summed by buyer and supplier, and only the sums meet the
    suppliers and nations; so the lines are shuffled once.
    """
    lines = f.table("lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    buyers = lookup.attach(
        f.table("orders").select("o_orderkey", "o_custkey"), "o_custkey",
        f.table("customer"), "c_custkey", {"c_nationkey": "buyer"})
    trade = lookup.attach(lines, "l_orderkey", buyers, "o_orderkey", {"buyer": "buyer"})
    sums = trade.groupBy("buyer", "l_suppkey").agg(
        F.count("*").alias("lines"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"))
    sums = lookup.attach(
        sums, "l_suppkey", f.table("supplier"), "s_suppkey", {"s_nationkey": "seller"})
    flows = sums.groupBy("buyer", "seller").agg(
        F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity"))
    for role in ("buyer", "seller"):
        flows = lookup.attach(
            flows, role, f.table("nation"), "n_nationkey", {"n_name": f"{role}_nation"})
    return flows.select("buyer_nation", "seller_nation", "lines",
                        F.col("quantity").cast("double").alias("quantity"))


def _urgent_orders(f: Flights) -> DataFrame:
    return f.table("orders").where(F.col("o_orderpriority") == "1-URGENT")


@query
def anti_join_not_in(f: Flights) -> DataFrame:
    """Customers without an urgent order."""
    customers = f.table("customer").select("c_custkey", "c_name", "c_mktsegment")
    return lookup.without_match(customers, "c_custkey", _urgent_orders(f), "o_custkey")


@query
def not_in_plain(f: Flights) -> DataFrame:
    """``NOT IN`` over a set without NULL: the same customers."""
    customers = f.table("customer").select("c_custkey", "c_name", "c_mktsegment")
    return lookup.not_in(customers, "c_custkey", _urgent_orders(f), "o_custkey")


@query
def anti_join_null_aware(f: Flights) -> DataFrame:
    """``NOT IN`` over a set with a NULL is empty; without match ignores it. Both are counted."""
    customers = f.table("customer").select("c_custkey")
    with_null = _urgent_orders(f).select(
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).alias("buyer"))
    ways = {
        "not in": lookup.not_in(customers, "c_custkey", with_null, "buyer"),
        "without match": lookup.without_match(customers, "c_custkey", with_null, "buyer"),
    }
    return audit.row_counts(ways)


# Star schema


@query
def dim_airport(f: Flights) -> DataFrame:
    return timeless(f.derived_airports())


@query
def distinct_airports(f: Flights) -> DataFrame:
    return f.airports.agg(F.countDistinct("icao_airport").alias("airports"))


@query
def fact_flights(f: Flights) -> DataFrame:
    return timeless(f.derived_fact())


@query
def fact_by_arrivals(f: Flights) -> DataFrame:
    """The fact from three loads, of which one delivers some steps of the others again."""
    path = f"{shared_folder(f.spark)}/tarmaq/arrivals-{uuid4().hex}"
    number = F.regexp_extract(SOURCE_FILE, r"VRA_(\d+)", 1)
    load = F.when(number == "", 1).otherwise(F.floor(number.try_cast("int") / 4))
    for part in (0, 1, 2):
        increment.add_arrivals(f.derived_silver().where(load == part), path, f.airlines, f.codes)
    return timeless(read_parts(f.spark, path, f.fact))


@query
def fact_after_month_refresh(f: Flights) -> DataFrame:
    """The fact of which one month was written without its cancelled steps, then built anew."""
    path = f"{shared_folder(f.spark)}/tarmaq/months-{uuid4().hex}"
    month = date(1995, 3, 1)
    wrong = (F.col(increment.MONTH) == F.lit(month)) & F.col("flight_cancelled")
    increment.write_steps(f.steps, path, f.airlines, f.codes, replace_parts,
                          lambda fact: fact.where(~F.coalesce(wrong, F.lit(False))))
    increment.rebuild_months(f.derived_silver(), [month], path, f.airlines, f.codes)
    return timeless(read_parts(f.spark, path, f.fact))


@query
def obt_flights(f: Flights) -> DataFrame:
    return timeless(f.derived_obt())


@query
def row_chain(f: Flights) -> DataFrame:
    return audit.row_chain(
        [("bronze", f.bronze), ("silver", f.derived_silver()), ("fact", f.fact), ("obt", f.obt)],
        [0, None, 0])


@query
def layer_counts(f: Flights) -> DataFrame:
    return audit.row_counts({
        "silver.vra": f.derived_silver(), "silver.airlines": f.airlines,
        "silver.aerodromes": f.aerodromes, "gold.dim_airport": f.airports,
        "gold.fact_flights": f.fact, "gold.obt_flights": f.obt,
    })


# Consumption


@query
def q1_punctuality(f: Flights) -> DataFrame:
    return rounded_means(consumption.punctuality_by_airline(f.obt))


@query
def q1b_judgeable_only(f: Flights) -> DataFrame:
    return rounded_means(consumption.punctuality_by_airline(f.obt, judgeable_only=True))


@query
def q2_routes(f: Flights) -> DataFrame:
    return rounded_means(consumption.busiest_routes(f.obt))


@query
def q3_cancellation(f: Flights) -> DataFrame:
    return consumption.cancellations_by_airline(f.obt)


@query
def q4_monthly(f: Flights) -> DataFrame:
    return rounded_means(consumption.monthly_trend(f.obt))


@query
def q5_hourly(f: Flights) -> DataFrame:
    return rounded_means(consumption.hourly_cascade(f.obt))


@query
def n1_city_delays(f: Flights) -> DataFrame:
    return consumption.late_departures_from(f.obt, "Cidade NATION_2")


@query
def n2_route_cancellation(f: Flights) -> DataFrame:
    return consumption.cancellation_rate_by_route(f.obt)


@query
def n3_monthly_recovery(f: Flights) -> DataFrame:
    return rounded_means(consumption.recovery_by_month(f.obt))


@query
def n4_foreign_cancellations(f: Flights) -> DataFrame:
    return consumption.foreign_cancellations(f.fact)


@query
def n5_worst_hour(f: Flights) -> DataFrame:
    return rounded_means(consumption.worst_hour(f.obt))


@query
def flights_by_status(f: Flights) -> DataFrame:
    return consumption.flights_by_status(f.obt)


@query
def delay_recovery(f: Flights) -> DataFrame:
    return consumption.delay_recovery(f.obt)


@query
def punctual_null_by_status(f: Flights) -> DataFrame:
    return consumption.unjudgeable_by_status(f.obt)


@query
def clustered_month_of_airline(f: Flights) -> DataFrame:
    """One month of one airline from the wide table, written in ranges of month and airline."""
    path = f"{shared_folder(f.spark)}/tarmaq/clustered-{uuid4().hex}"

    def wide_rows(steps: DataFrame) -> DataFrame:
        return gold.obt_flights(gold.fact_of_steps(steps, f.airlines, f.codes), f.airports)

    write_clustered(increment.month_of(f.steps), path,
                    ["reference_month", "icao_airline", "flight_number"], derive=wide_rows)
    wide = f.spark.read.parquet(path)
    chosen = wide.where((F.col("reference_month") == F.lit(date(1995, 3, 1)))
                        & (F.col("icao_airline") == "A007"))
    return chosen.select(*gold.STEP_KEYS, "airline_name", "departure_punctual", "route_icao")


# Audits


@query
def carrier_skew(f: Flights) -> DataFrame:
    return audit.key_skew(f.fact, "icao_airline")


@query
def supplier_skew(f: Flights) -> DataFrame:
    return audit.key_skew(
        f.table("lineitem").select(F.col("l_suppkey").cast("string").alias("supplier")), "supplier")


@query
def monthly_extremes(f: Flights) -> DataFrame:
    return audit.extremes(f.fact, "reference_month")


@query
def doc_coverage(f: Flights) -> DataFrame:
    """Documents stand for columns and labels for their comments: which lack one?"""
    labels = f.table("labels").select("doc_id").distinct().withColumn("labelled", F.lit(True))
    documents = f.table("documents").select("doc_id", "source", "lang")
    return audit.coverage(documents.join(labels, "doc_id", "left"), ["source", "lang"],
                          F.col("labelled").isNotNull())


@query
def tag_missing(f: Flights) -> DataFrame:
    """Documents that lack the tag: no label row says they are of good quality."""
    tagged = f.table("labels").where(F.col("quality") == 1)
    documents = f.table("documents").select("doc_id", "source", "lang")
    return lookup.not_in(documents, "doc_id", tagged, "doc_id")


@query
def tag_listing(f: Flights) -> DataFrame:
    """Each label column as a tag: name, value and number of documents that carry it."""
    labels = f.table("labels")
    tags = labels.select(F.inline(F.array(*[
        F.struct(F.lit(tag).alias("tag_name"), F.col(tag).cast("string").alias("tag_value"))
        for tag in ("quality", "toxic")
    ])))
    listed = audit.listing(tags, ["tag_name", "tag_value"])
    return listed.withColumnRenamed("rows", "documents")


@query
def lineage_edges(f: Flights) -> DataFrame:
    """The event table as a run log: event type feeds user, errors have no known source."""
    log = f.table("events").select(
        F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("").alias("source"),
        F.concat(F.lit("lake.user_"), F.col("user_id").cast("string")).alias("target"), "ts")
    return audit.lineage_edges(
        log, "source", "target", "ts", F.lit("2024-01-31").cast("date"), days=7, prefix="lake.")


def _order_snapshots(f: Flights) -> str:
    """Orders loaded twice: the years before 1996, then all of them."""
    root = f"{shared_folder(f.spark)}/tarmaq/orders-{uuid4().hex}"
    orders = f.table("orders")
    write_snapshot(orders.where(F.col("o_orderdate") < F.lit("1996-01-01")), root)
    write_snapshot(orders, root)
    return root


@query
def snapshot_compare(f: Flights) -> DataFrame:
    root = _order_snapshots(f)
    return audit.snapshot_compare({
        "version 0": read_snapshot(f.spark, root, 0), "current": read_snapshot(f.spark, root),
    }, "o_orderdate")


@query
def load_ledger(f: Flights) -> DataFrame:
    history = load_history(f.spark, _order_snapshots(f))
    return history.select("version", "operation", "rows_written")


def bind(build: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(Flights(spark, folder.rstrip("/")))
