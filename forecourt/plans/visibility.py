"""The staged run of all rules over a price table."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import date
from functools import partial
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.prices import day
from forecourt.operators import activation, expiry, extract, in_report, replacement, summary
from forecourt.operators.changes import (
    BROADCAST_CHANGES,
    GRAINS,
    RULE_ORDER,
    apply_changes,
    checked_rows,
    joined_in_place,
    joined_with,
    outcomes,
    outcomes_in_place,
    store_changes,
    union_all,
    with_outcome,
)
from forecourt.operators.skew import group_apart
from forecourt.session import (
    IN_BUCKETS,
    SMALL_PARTS_HASHED,
    materialise,
    materialise_buckets,
    materialise_seen,
    require_utc,
    run_folder,
    settings,
)

WORKING_COLUMNS = ["station_id", "product_id", "price", "source", "show_in_report", "updated_at"]

# rows of the working copy that a bucket of stations has on average; a station with more rows than
# the second number is not put in a bucket, its rows are spread over tasks by their finer keys
BUCKET_ROWS = 100_000
STATION_ROWS = 1_000_000

# how a table on the way is kept: the frame and a name
Keep = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class PriceTables:
    prices: DataFrame  # station_id, product_id, price, source, show_in_report, updated_at, updated_by_id
    stations: DataFrame  # id, region_id
    customer_stations: DataFrame  # id, station_id, customer_id
    customers: DataFrame  # id, status
    competitors: DataFrame  # station_id, customer_station_id


def expiry_changes(snapshot: DataFrame, as_of: date, keep: Keep = materialise) -> DataFrame:
    return expiry.off_expired(
        snapshot,
        as_of,
        (
            ("off_expired_trusted", refdata.TRUSTED_SOURCES, refdata.TRUSTED_EXPIRY_DAYS),
            ("off_expired_untrusted", refdata.UNTRUSTED_SOURCES, refdata.UNTRUSTED_EXPIRY_DAYS),
        ),
    )


def source_changes(snapshot: DataFrame, as_of: date, keep: Keep = materialise) -> DataFrame:
    """The rules share one summary per product and, from it, one per source; the products to
    show for three of them come from one join."""
    products = keep(summary.product_summary(snapshot, as_of), "products")
    quality = keep(summary.judge_sources(products), "sources")
    scored = keep(activation.pick_sources(quality, as_of), "picked-sources")
    swaps = keep(replacement.pick_replacements(quality), "replacements")
    race = keep(replacement.pick_race(quality), "races")
    chosen = union_all(
        [
            activation.partial_keys(scored, as_of, "on_partial_trusted", refdata.TRUSTED_SOURCES, 0),
            activation.partial_keys(
                scored,
                as_of,
                "on_partial_untrusted",
                refdata.UNTRUSTED_SOURCES,
                refdata.UNTRUSTED_WINDOW_DAYS,
            ),
            replacement.replacing_keys(swaps, as_of),
        ]
    )
    return union_all(
        [
            activation.on_new_trusted(scored, as_of),
            activation.on_new_untrusted(scored, as_of),
            activation.show_within_limits(chosen, products, as_of),
            replacement.off_replaced_source(swaps),
            replacement.off_yandex_for_benzuber(race),
            replacement.on_benzuber(race, as_of),
            expiry.off_products_beyond(products),
        ]
    )


def in_report_changes(snapshot: DataFrame, as_of: date, keep: Keep = materialise) -> DataFrame:
    products = keep(in_report.in_report_products(snapshot, as_of), "in-report-products")
    base = in_report.base_sources(products)
    return union_all(
        [in_report.show_new_products(products, base, as_of), in_report.hide_stale_products(products, base)]
    )


def diesel_changes(snapshot: DataFrame, as_of: date, keep: Keep = materialise) -> DataFrame:
    return expiry.off_old_diesel(snapshot)


# stage, its rules, the grains of their changes
STAGES = (
    ("expiry", expiry_changes, ("source",)),
    ("sources", source_changes, ("source", "source_product")),
    ("in_report", in_report_changes, ("source_product",)),
    ("diesel", diesel_changes, ("product",)),
)


def after_stage(state: list[DataFrame], changes: DataFrame, grains: tuple[str, ...], rows: int) -> list[DataFrame]:
    """The working rows after a stage, as parts to be united.

    Only the rows of the stations that the stage changed are read again, and get that stage's own
    changes; the other rows stay where they were written.
    """
    if not rows:
        return state
    changed = group_apart(changes, ["station_id"])
    again = union_all(part.join(changed, "station_id", "left_semi") for part in state)
    again = materialise(apply_changes(again, changes, grains=grains, rows=rows), "prices-changed")
    return [*(part.join(changed, "station_id", "left_anti") for part in state), again]


@dataclass(frozen=True)
class Part:
    """Some stations, with all their rows: in buckets of stations, or spread."""

    rows: DataFrame  # WORKING_COLUMNS, whatever their age
    buckets: int | None

    def keep(self) -> Keep:
        return partial(materialise_buckets, key="station_id", buckets=self.buckets) if self.buckets else materialise

    def planning(self):
        return settings(self.rows.sparkSession, IN_BUCKETS) if self.buckets else nullcontext()


@dataclass(frozen=True)
class Found:
    part: Part
    stages: list[tuple[DataFrame, tuple[str, ...]]]  # changes and their grains, of the stages that have any
    changes: DataFrame
    total: int

    def outcomes(self) -> DataFrame:
        with self.part.planning():
            if self.part.buckets:
                return materialise(outcomes_in_place(self.part.rows, self.stages), "outcomes")
            return materialise(outcomes(self.part.rows, self.changes, RULE_ORDER, tuple(GRAINS)), "outcomes")


def parts_of(rows: DataFrame, bucket_rows: int = BUCKET_ROWS, station_rows: int = STATION_ROWS) -> list[Part]:
    """The rows in buckets of stations, and apart from them those of the stations with very many, if there are any.

    All rules and changes are about one station, so the two parts are worked on one after the other.
    """
    spread, seen = materialise_seen(rows, "prices-in-scope", n=F.count(F.lit(1)))
    buckets = max(1, ceil((seen["n"] or 0) / bucket_rows))
    hot, parts = None, []
    if buckets > 1:
        per_station = spread.groupBy("station_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > station_rows)
        hot, seen = materialise_seen(per_station.select("station_id"), "hot-stations", n=F.count(F.lit(1)))
        if seen["n"]:
            parts = [Part(materialise(spread.join(hot, "station_id", "left_semi"), "prices-hot"), None)]
            spread = spread.join(hot, "station_id", "left_anti")
    return [Part(materialise_buckets(spread, "prices-by-station", "station_id", buckets), buckets), *parts]


def stages_spread(part: Part, as_of: date) -> Found:
    """All stages over rows that are anywhere; after a stage the rows of its stations are written."""
    state = [recent_rows(part.rows, as_of)]
    done: list[DataFrame] = []
    total = 0
    for stage, rules, grains in STAGES:
        found = rules(extract.as_snapshot(union_all(state), as_of), as_of)
        changes, rows = store_changes(found, f"changes-{stage}", grains=grains)
        done.append(changes)
        total += rows
        if stage != STAGES[-1][0]:
            state = after_stage(state, changes, grains, rows)
    return Found(part, [], union_all(done), total)


def stages_in_buckets(part: Part, as_of: date) -> Found:
    """All stages over rows in buckets of stations: summaries, changes and rows meet in their bucket.

    What a stage leaves is written where two later steps read it, so not before the last stage.
    """
    keep, state = part.keep(), recent_rows(part.rows, as_of)
    done: list[DataFrame] = []
    stages: list[tuple[DataFrame, tuple[str, ...]]] = []
    total = 0
    for stage, rules, grains in STAGES:
        changes = keep(rules(extract.as_snapshot(state, as_of), as_of, keep), f"changes-{stage}")
        rows = checked_rows(changes, RULE_ORDER, grains)
        done.append(changes)
        total += rows
        if rows:
            stages.append((changes, grains))
        if rows and stage != STAGES[-1][0]:
            state = with_outcome(joined_in_place(state, stages[-1:]), WORKING_COLUMNS)
            state = state if stage == STAGES[-2][0] else keep(state, "prices-changed")
    return Found(part, stages, union_all(done), total)


def recent_rows(rows: DataFrame, as_of: date) -> DataFrame:
    """No rule can see any other row, whatever the stages before it changed."""
    longest = max(refdata.SHOWN_DAYS, refdata.HIDDEN_DAYS)
    return rows.where(F.col("updated_at") > day(as_of, -longest))


def find_changes(
    tables: PriceTables, as_of: date, bucket_rows: int = BUCKET_ROWS, station_rows: int = STATION_ROWS
) -> list[Found]:
    """All changes of one run, stage by stage.

    The stages work on the recent rows of the stations in scope, with the columns the rules
    need. The rows of these stations are written once, and after a stage.
    """
    rows = extract.in_scope(
        tables.prices.select(*WORKING_COLUMNS),
        tables.stations,
        tables.customer_stations,
        tables.customers,
        tables.competitors,
    )
    found = []
    with settings(rows.sparkSession, SMALL_PARTS_HASHED):
        parts = parts_of(rows, bucket_rows, station_rows)
    for part in parts:
        with part.planning():
            found.append((stages_in_buckets if part.buckets else stages_spread)(part, as_of))
    return found


def visibility_changes(tables: PriceTables, as_of: date) -> tuple[DataFrame, int]:
    """All changes of one run, and their number."""
    found = find_changes(tables, as_of)
    return union_all(f.changes for f in found), sum(f.total for f in found)


def price_visibility(
    tables: PriceTables,
    as_of: date,
    broadcast_rows: int = BROADCAST_CHANGES,
    bucket_rows: int = BUCKET_ROWS,
    station_rows: int = STATION_ROWS,
) -> DataFrame:
    """The price table after one run: a single pass over it with the changes of all stages.

    The changes are sent to every task up to ``broadcast_rows`` of them; beyond, the outcome is worked out on the rows
    already written, and the table is joined with it. What is written on the way is kept until ``session.remove_runs``,
    or goes to the caller's ``run_folder``.
    """
    require_utc(tables.prices.sparkSession)
    with run_folder(tables.prices.sparkSession, keep=True):
        found = find_changes(tables, as_of, bucket_rows, station_rows)
        total = sum(f.total for f in found)
        if total <= broadcast_rows:
            return apply_changes(tables.prices, union_all(f.changes for f in found), rows=total)
        known = union_all(f.outcomes() for f in found)
        return with_outcome(joined_with(tables.prices, known, "shuffle_hash"), tables.prices.columns)
