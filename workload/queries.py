"""One query per operator, over the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions import geo, prices, text
from forecourt.functions import registry as records
from forecourt.operators import (
    activation,
    changes,
    competitors,
    expiry,
    extract,
    in_report,
    knn,
    registry,
    replacement,
    stations,
    summary,
)
from forecourt.plans import enrichment, nearest, visibility
from forecourt.session import materialise, run_folder, tune
from forecourt.sources.readers import read_ids
from forecourt.sources.readers import scan_points as read_point_lines
from forecourt.sources.sinks import write_table
from workload import fixtures as fx
from workload.fixtures import AS_OF

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
K = 5


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # intermediate tables of a query share a folder; session.remove_runs removes it
        with run_folder(spark, keep=True):
            return build(tune(spark), str(sf_dir))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


def clients(spark, sf):
    return extract.client_stations(fx.customer_stations(spark, sf), fx.customers(spark, sf))


def protected(spark, sf):
    return extract.protected_stations(clients(spark, sf), fx.competitors(spark, sf))


def scored(spark, sf):
    return activation.score_new_sources(fx.snapshot(spark, sf), AS_OF)


def swaps(spark, sf):
    return replacement.source_replacement(fx.snapshot(spark, sf), AS_OF)


def products_read_once(spark, sf):
    """Summary per product and, from it, per source: rules that need both read the prices once."""
    products = materialise(summary.product_summary(fx.snapshot(spark, sf), AS_OF), "products")
    return products, summary.judge_sources(products)


def race(spark, sf):
    return replacement.count_race(fx.snapshot(spark, sf), AS_OF)


def directory(spark, sf):
    return stations.station_directory(
        fx.gas_stations(spark, sf), fx.addresses(spark, sf), fx.brands(spark, sf), fx.regions(spark, sf)
    )


def points(spark, sf):
    return stations.station_points(fx.gas_stations(spark, sf), fx.addresses(spark, sf))


def classed_pairs(spark, sf):
    """Neighbour pairs with the class of both ends."""
    classes = directory(spark, sf).select("id_parcon", "check")
    return (
        knn.knn_pairs(points(spark, sf), K)
        .join(classes.toDF("point1", "client_check"), "point1")
        .join(classes.toDF("point2", "comp_check"), "point2")
    )


def all_changes(spark, sf):
    """Changes of every rule, all computed on the initial snapshot."""
    snap = materialise(fx.snapshot(spark, sf), "snapshot")
    return changes.union_all([rules(snap, AS_OF) for _, rules, _ in visibility.STAGES])


# --- sources ---------------------------------------------------------------------------


@query
def scan_directory(spark, sf):
    active = stations.active_stations(fx.gas_stations(spark, sf))
    return active.select("gs_id", "owner_type", "type", "status_gs", "owner_number")


@query
def scan_prices(spark, sf):
    return fx.snapshot(spark, sf)


@query
def dim_limits(spark, sf):
    seen = fx.snapshot(spark, sf).groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    return prices.with_limits(seen).select("product_id", "lo", "hi", "n")


@query
def id_list(spark, sf):
    with run_folder(spark) as folder:
        path = f"{folder}/ids"
    fx.company_ids(spark, sf).write.text(path)
    return read_ids(spark, path).groupBy("itn").agg(F.count(F.lit(1)).alias("lines"))


@query
def scan_points(spark, sf):
    """A coordinate file with some broken lines."""
    with run_folder(spark) as folder:
        path = f"{folder}/points"
    fx.point_lines(spark, sf).write.text(path)
    return read_point_lines(spark, path)


@query
def point_counts(spark, sf):
    """Counts filled by the pass that reads the good points."""
    counts = Observation("points")
    used = stations.station_points(fx.gas_stations(spark, sf), fx.broken_addresses(spark, sf), counts=counts)
    kept = used.agg(F.count(F.lit(1)).alias("kept")).first()["kept"]
    found = counts.get
    return spark.createDataFrame([(found["located"], found["malformed"], kept)], "located bigint, malformed bigint, kept bigint")


# --- extraction ------------------------------------------------------------------------


@query
def client_stations(spark, sf):
    return clients(spark, sf)


@query
def competitor_stations(spark, sf):
    return extract.competitor_stations(clients(spark, sf), fx.competitors(spark, sf))


@query
def protected_union(spark, sf):
    return protected(spark, sf)


@query
def exclude_protected(spark, sf):
    rows = fx.snapshot(spark, sf).select("station_id", "product_id", "source")
    return extract.exclude_stations(rows, protected(spark, sf))


@query
def recency_filter(spark, sf):
    recent = extract.recency_filter(fx.prices(spark, sf), AS_OF)
    return recent.select("station_id", "product_id", "source", "show_in_report")


@query
def price_extract(spark, sf):
    return extract.price_extract(
        fx.prices(spark, sf),
        fx.price_stations(spark, sf),
        fx.customer_stations(spark, sf),
        fx.customers(spark, sf),
        fx.competitors(spark, sf),
        AS_OF,
    )


# --- counts and checks -----------------------------------------------------------------


@query
def interval_checks(spark, sf):
    price, lo, hi = F.col("price"), F.col("lo"), F.col("hi")
    return prices.with_limits(fx.snapshot(spark, sf)).select(
        "station_id",
        "source",
        "product_id",
        prices.fails_open(price, lo, hi).alias("fails_open"),
        prices.passes_closed(price, lo, hi).alias("passes_closed"),
    )


@query
def limit_check(spark, sf):
    checked = summary.limit_check(fx.snapshot(spark, sf), AS_OF)
    return checked.select("station_id", "source", "total", "count_fuel", "bad")


@query
def source_quality(spark, sf):
    judged = summary.source_quality(fx.snapshot(spark, sf), AS_OF)
    return judged.select("station_id", "source", "total", "bad", "check", "count_err")


@query
def count_fuel(spark, sf):
    return summary.count_fuel(fx.snapshot(spark, sf))


@query
def sources_per_station(spark, sf):
    return summary.sources_per_station(fx.snapshot(spark, sf))


@query
def single_source_stations(spark, sf):
    return summary.single_source_stations(fx.snapshot(spark, sf))


@query
def dark_stations(spark, sf):
    return summary.dark_stations(fx.snapshot(spark, sf), AS_OF)


@query
def rank_lookup(spark, sf):
    per_source = fx.snapshot(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return per_source.withColumn("rate", prices.source_rank(F.col("source")))


@query
def scalar_dates(spark, sf):
    stamp = F.col("updated_at")
    in_day = (stamp >= prices.day(AS_OF)) & (stamp < prices.day(AS_OF, 1))
    return fx.prices(spark, sf).select(
        "station_id",
        "product_id",
        "source",
        F.to_date(stamp).alias("date_upd"),
        F.date_sub(F.to_date(stamp), 6).alias("six_days_before"),
        F.to_date(stamp + F.expr("INTERVAL 1 DAY")).alias("next_day"),
        F.datediff(prices.day(AS_OF), F.to_date(stamp)).alias("age_days"),
        in_day.alias("in_day"),
        prices.recent(F.col("show_in_report"), stamp, AS_OF).alias("recent"),
    )


# --- rules -----------------------------------------------------------------------------


@query
def expired_sources(spark, sf):
    return expiry.expired_sources(
        fx.snapshot(spark, sf), AS_OF, refdata.TRUSTED_SOURCES, refdata.TRUSTED_EXPIRY_DAYS
    )


@query
def off_expired_trusted(spark, sf):
    return expiry.off_expired_trusted(fx.snapshot(spark, sf), AS_OF)


@query
def off_expired_untrusted(spark, sf):
    return expiry.off_expired_untrusted(fx.snapshot(spark, sf), AS_OF)


@query
def source_candidates(spark, sf):
    return activation.source_candidates(fx.snapshot(spark, sf), AS_OF)


@query
def score_new_sources(spark, sf):
    return scored(spark, sf)


@query
def best_source(spark, sf):
    return scored(spark, sf).select("station_id", "source", "rate")


@query
def on_new_trusted(spark, sf):
    return activation.on_new_trusted(scored(spark, sf), AS_OF)


@query
def on_new_untrusted(spark, sf):
    return activation.on_new_untrusted(scored(spark, sf), AS_OF)


@query
def on_partial_trusted(spark, sf):
    products, quality = products_read_once(spark, sf)
    scores = activation.pick_sources(quality, AS_OF)
    return activation.on_partial_trusted(scores, fx.snapshot(spark, sf), AS_OF, products=products)


@query
def on_partial_untrusted(spark, sf):
    products, quality = products_read_once(spark, sf)
    scores = activation.pick_sources(quality, AS_OF)
    return activation.on_partial_untrusted(scores, fx.snapshot(spark, sf), AS_OF, products=products)


@query
def in_report_new_products(spark, sf):
    return in_report.in_report_new_products(fx.snapshot(spark, sf), AS_OF)


@query
def equivalent_product_dup(spark, sf):
    return in_report.equivalent_product_dup(*in_report.equivalence_input(fx.snapshot(spark, sf), AS_OF))


@query
def on_in_report_new(spark, sf):
    return in_report.on_in_report_new(fx.snapshot(spark, sf), AS_OF)


@query
def off_stale_in_report(spark, sf):
    return in_report.off_stale_in_report(fx.snapshot(spark, sf), AS_OF)


@query
def source_replacement(spark, sf):
    return swaps(spark, sf)


@query
def coalesce_update(spark, sf):
    """Sources to replace per station, corrected by the count of all sources where that is more than one."""
    shown = fx.snapshot(spark, sf).where("show_in_report = 't'")
    own = summary.sources_per_station(shown.where(F.col("source").isin(*refdata.REPLACEABLE_SOURCES)))
    other = summary.sources_per_station(shown).where("count_source > 1")
    return replacement.coalesce_update(own, other, "station_id", "count_source")


@query
def off_replaced_source(spark, sf):
    return replacement.off_replaced_source(swaps(spark, sf))


@query
def on_replacing_source(spark, sf):
    products, quality = products_read_once(spark, sf)
    found = replacement.pick_replacements(quality)
    return replacement.on_replacing_source(found, fx.snapshot(spark, sf), AS_OF, products=products)


@query
def count_race(spark, sf):
    return race(spark, sf)


@query
def off_yandex_for_benzuber(spark, sf):
    return replacement.off_yandex_for_benzuber(race(spark, sf))


@query
def on_benzuber(spark, sf):
    return replacement.on_benzuber(race(spark, sf), AS_OF)


@query
def out_of_bounds(spark, sf):
    return expiry.out_of_bounds(fx.snapshot(spark, sf))


@query
def off_out_of_bounds(spark, sf):
    return expiry.off_out_of_bounds(fx.snapshot(spark, sf))


@query
def diesel_duplicates(spark, sf):
    return expiry.diesel_duplicates(fx.snapshot(spark, sf))


@query
def off_old_diesel(spark, sf):
    return expiry.off_old_diesel(fx.snapshot(spark, sf))


@query
def report_lines(spark, sf):
    return changes.change_text(all_changes(spark, sf))


@query
def report_text(spark, sf):
    """The lines of every rule about a station, joined, three at most in a text."""
    return changes.change_report(all_changes(spark, sf), lines=3)


@query
def apply_changes(spark, sf):
    """Every rule's changes, computed on the initial table, run in order."""
    found, rows = changes.store_changes(all_changes(spark, sf))
    done = changes.apply_changes(fx.prices(spark, sf), found, rows=rows)
    return done.select("station_id", "product_id", "source", "show_in_report", "updated_by_id")


@query
def price_visibility(spark, sf):
    done = visibility.price_visibility(fx.price_tables(spark, sf), AS_OF)
    return done.select("station_id", "product_id", "source", "price", "show_in_report", "updated_by_id")


# --- the same over a table with every limit, rank and age, several rows of a key, and missing values ------------


def full_snapshot(spark, sf):
    return fx.snapshot_of(fx.full_prices(spark, sf))


def full_changes(spark, sf):
    snap = materialise(full_snapshot(spark, sf), "snapshot")
    return changes.union_all([rules(snap, AS_OF) for _, rules, _ in visibility.STAGES])


def with_day(table):
    return table.select(
        "station_id", "product_id", "source", "price", F.to_date("updated_at").alias("day"), "show_in_report", "updated_by_id"
    )


@query
def full_limits(spark, sf):
    seen = full_snapshot(spark, sf).groupBy("product_id", "price").agg(F.count(F.lit(1)).alias("n"))
    checked = prices.with_limits(seen)
    price, lo, hi = F.col("price"), F.col("lo"), F.col("hi")
    return checked.select(
        "product_id", "price", "lo", "hi", "n",
        prices.fails_open(price, lo, hi).alias("fails"), prices.passes_closed(price, lo, hi).alias("passes"),
    )


@query
def full_ranks(spark, sf):
    seen = full_snapshot(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return seen.select("source", "n", prices.source_rank(F.col("source")).alias("rate"), prices.source_class(F.col("source")).alias("class"))


@query
def full_extract(spark, sf):
    """Rows at both limits of age and beyond them, and rows without a flag."""
    tables = fx.full_tables(spark, sf)
    return extract.price_extract(
        tables.prices, tables.stations, tables.customer_stations, tables.customers, tables.competitors, AS_OF
    )


@query
def full_rules(spark, sf):
    """The changes of all fourteen rules."""
    return full_changes(spark, sf)


@query
def full_applied(spark, sf):
    done = changes.apply_changes(fx.full_prices(spark, sf), materialise(full_changes(spark, sf), "changes"))
    return with_day(done)


@query
def full_applied_by_outcome(spark, sf):
    """As full_applied, by the way for change-sets too large to be sent to every task."""
    found = materialise(full_changes(spark, sf), "changes")
    done = changes.apply_changes(fx.full_prices(spark, sf), found, broadcast_rows=0)
    return with_day(done)


@query
def full_visibility(spark, sf):
    done = visibility.price_visibility(fx.full_tables(spark, sf), AS_OF)
    return with_day(done)


# --- stations --------------------------------------------------------------------------


@query
def parse_gps(spark, sf):
    gps = F.col("gps_var")
    return fx.addresses(spark, sf).select(
        "gs_id", text.gps_part(gps, 1).alias("lat_text"), text.gps_part(gps, -1).alias("lon_text")
    )


@query
def try_number(spark, sf):
    station = fx.gas_stations(spark, sf).join(fx.addresses(spark, sf), "gs_id")
    return station.select(
        "gs_id",
        text.number_or_null(text.gps_part(F.col("gps_var"), 1)).alias("lat"),
        text.integer_or_null(F.col("owner_number")).alias("number"),
        text.integer_or_null(F.col("owner_type")).alias("no_number"),
    )


@query
def scalar_text(spark, sf):
    gps, km = F.col("gps_var"), F.col("road_km")
    return fx.addresses(spark, sf).select(
        "gs_id",
        F.length(F.trim(gps)).alias("gps_length"),
        F.left(gps, F.lit(2)).alias("first_two"),
        F.right(gps, F.lit(2)).alias("last_two"),
        F.substring_index(gps, ".", 1).alias("whole_degrees"),
        F.concat(F.lit("km "), F.round(km / 7, 0).cast("bigint").cast("string")).alias("km_text"),
    )


@query
def address_text(spark, sf):
    columns = ("road_number", "road_km", "side", "city", "locality", "street", "building")
    line = text.address_text(*(F.col(c) for c in columns))
    return fx.addresses(spark, sf).select("gs_id", text.drop_last_comma(line).alias("address"))


@query
def station_class(spark, sf):
    return fx.gas_stations(spark, sf).select(
        "gs_id", "type", text.station_class(F.col("type")).alias("station_class")
    )


@query
def station_points(spark, sf):
    return points(spark, sf)


@query
def station_directory(spark, sf):
    return directory(spark, sf)


@query
def haversine(spark, sf):
    """Distance from each station to the one with the next id."""
    here, there = points(spark, sf), points(spark, sf).toDF("next_id", "lat2", "lon2")
    km = geo.haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    return here.join(there, F.col("id") + 1 == F.col("next_id")).select("id", "next_id", F.round(km, 6).alias("km"))


def to_a_millimetre(pairs):
    """Doubles of two engines agree to their last digits only."""
    return pairs.withColumn(knn.DISTANCE, F.round(F.col(f"`{knn.DISTANCE}`"), knn.DISTANCE_DIGITS))


@query
def knn_pairs(spark, sf):
    return to_a_millimetre(knn.knn_pairs(points(spark, sf), K))


@query
def knn_long(spark, sf):
    return to_a_millimetre(knn.wide_to_long(knn.long_to_wide(knn.knn_pairs(points(spark, sf), 3))))


@query
def class_compatible(spark, sf):
    return competitors.class_compatible(classed_pairs(spark, sf)).select(
        "point1", "point2", "client_check", "comp_check"
    )


@query
def competitor_sequence(spark, sf):
    pairs = competitors.class_compatible(classed_pairs(spark, sf))
    return competitors.competitor_sequence(pairs).select("point1", "point2", "sequence")


@query
def competitor_enrich(spark, sf):
    return to_a_millimetre(nearest.enriched_pairs(fx.station_tables(spark, sf), K))


@query
def competitor_price_sources(spark, sf):
    return competitors.competitor_price_sources(fx.price_stations(spark, sf), fx.prices(spark, sf), AS_OF)


@query
def best_price_class(spark, sf):
    sources = competitors.competitor_price_sources(fx.price_stations(spark, sf), fx.prices(spark, sf), AS_OF)
    return competitors.best_price_class(sources)


@query
def nearest_competitors(spark, sf):
    return to_a_millimetre(nearest.nearest_competitors(fx.station_tables(spark, sf), K, AS_OF))


# --- registry --------------------------------------------------------------------------


@query
def registry_lookup(spark, sf):
    return registry.registry_lookup(fx.company_ids(spark, sf), fx.registry(spark, sf))


@query
def registry_flatten(spark, sf):
    return enrichment.company_table(fx.company_ids(spark, sf), fx.registry(spark, sf))


@query
def apply_no_changes(spark, sf):
    """An empty change-set leaves every row as it is."""
    done = changes.apply_changes(fx.prices(spark, sf), spark.createDataFrame([], changes.CHANGE_SCHEMA))
    return done.select("station_id", "product_id", "source", "show_in_report", "updated_by_id")


@query
def registry_sink(spark, sf):
    run_id = uuid.uuid4().hex
    with run_folder(spark) as folder:
        path = enrichment.write_company_table(fx.company_ids(spark, sf), fx.registry(spark, sf), folder, run_id)
    return spark.read.parquet(path).select("itn", "name", "type", "status_itn")


@query
def table_sink(spark, sf):
    """A table under a fixed name, replaced by what is left of itself."""
    with run_folder(spark) as folder:
        path = write_table(directory(spark, sf), f"{folder}/directory")
    write_table(spark.read.parquet(path).where("check > 0"), path)
    return spark.read.parquet(path)


@query
def registry_last(spark, sf):
    """Several records of an id, loaded one after the other; the later one may be smaller as a text."""
    return registry.registry_lookup(fx.company_ids(spark, sf), fx.registry_history(spark, sf))


@query
def registry_contacts(spark, sf):
    """Lists of phones and e-mail addresses in all shapes, broken records among them."""
    found = registry.registry_lookup(fx.company_ids(spark, sf), fx.registry_history(spark, sf))
    return registry.registry_flatten(found, "null").select("itn", "name", "phone", "email", "okved", "kpp")


@query
def registry_counts(spark, sf):
    """Counts filled by the pass that flattens the records."""
    counts = Observation("records")
    flat = enrichment.company_table(fx.company_ids(spark, sf), fx.registry_history(spark, sf), "null", counts)
    named = flat.agg(F.count_if(F.col("name") != "").alias("named")).first()["named"]
    found = counts.get
    rows = [(found["ids"], found["missing"], found["malformed"], named)]
    return spark.createDataFrame(rows, "ids bigint, missing bigint, malformed bigint, named bigint")


@query
def json_path_default(spark, sf):
    record = F.col("record")
    return registry.parse_records(fx.registry(spark, sf)).select(
        "itn",
        records.path_or_default(record, "$[0].value").alias("name"),
        records.path_or_default(record, "$[0].data.phones").alias("phones"),
        records.path_or_default(record, "$[0].data.emails", "none").alias("emails"),
        records.path_or_default(record, "$[0].data.fio.patronymic").alias("patronymic"),
        records.path_or_default(record, "$[0].data.state.actuality_date", None).alias("millis"),
    )


@query
def epoch_text(spark, sf):
    stamps = fx.table(spark, sf, "customer").selectExpr(
        "c_custkey AS id",
        """CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN '' WHEN 3 THEN CAST(c_custkey % 1000 AS STRING)
             WHEN 4 THEN CAST(-1500 - c_custkey AS STRING) WHEN 5 THEN concat('x', CAST(c_custkey AS STRING), '000')
             ELSE CAST(1600000000000 + c_custkey * 86400123 AS STRING) END AS millis""",
    )
    return stamps.select("id", "millis", records.epoch_text(F.col("millis")).alias("updated"))


@query
def director_name(spark, sf):
    record = F.col("record")

    def at(path):
        return records.path_or_default(record, f"$[0].data.{path}")

    name = records.director_name(
        at("type"), at("fio.surname"), at("fio.name"), at("fio.patronymic"), at("management.name")
    )
    return registry.parse_records(fx.registry(spark, sf)).select("itn", name.alias("director"))


@query
def code_translate(spark, sf):
    record = F.col("record")
    kind = records.path_or_default(record, "$[0].data.type")
    state = records.path_or_default(record, "$[0].data.state.status")
    codes = registry.parse_records(fx.registry(spark, sf)).select("itn", kind.alias("kind"), state.alias("state"))
    return codes.select(
        "itn",
        records.translate_code(F.col("kind"), refdata.LEGAL_FORMS).alias("type"),
        records.translate_code(F.col("state"), refdata.COMPANY_STATUSES, "null").alias("status"),
    )
