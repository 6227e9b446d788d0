"""Change-sets: what a rule wants to alter, and applying that to the price table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.prices import lookup
from forecourt.operators.skew import group_apart
from forecourt.session import materialise, materialise_seen

CHANGE_COLUMNS = {
    "rule": "string",
    "station_id": "bigint",
    "source": "string",
    "product_id": "bigint",
    "from_date": "date",
    "to_date": "date",
    "only_flag": "string",
    "new_flag": "string",
}
CHANGE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in CHANGE_COLUMNS.items())

# order in which the rules' updates run
RULE_ORDER = (
    "off_expired_trusted",
    "off_expired_untrusted",
    "on_new_trusted",
    "on_new_untrusted",
    "on_partial_trusted",
    "on_partial_untrusted",
    "off_replaced_source",
    "on_replacing_source",
    "off_yandex_for_benzuber",
    "on_benzuber",
    "off_out_of_bounds",
    "on_in_report_new",
    "off_stale_in_report",
    "off_old_diesel",
)

# which columns say what a change is about
GRAINS = {
    "source": ["station_id", "source"],
    "source_product": ["station_id", "source", "product_id"],
    "product": ["station_id", "product_id"],
    "station": ["station_id"],
}

# a change-set of at most so many rows, some 150 bytes each, is sent to every task
BROADCAST_CHANGES = 300_000

# what decides, besides the changes, on the outcome of a row
ROW_KEY = ["station_id", "source", "product_id", "updated_at", "show_in_report"]


def change(
    keys: DataFrame,
    rule: str | Column,
    new_flag: str,
    from_date: date | Column | None = None,
    to_date: date | Column | None = None,
    only_flag: str | None = None,
    grain: str | None = None,
) -> DataFrame:
    """Change-set from keys: station_id alone or with source, product_id or both.

    ``grain`` says which of these columns the changes are about; without it, all that
    ``keys`` has. Keys with a NULL in one of them concern no row and are left out, so a
    missing value never widens an update. A row of the table is concerned when
    from_date <= updated_at < to_date; a date not given does not restrict.
    """
    about = [c for c in GRAINS["source_product"] if c in (GRAINS[grain] if grain else keys.columns)]
    keys = keys.dropna(subset=about)
    fixed = {"rule": rule, "new_flag": new_flag, "from_date": from_date, "to_date": to_date, "only_flag": only_flag}
    columns = []
    for name, kind in CHANGE_COLUMNS.items():
        if name in fixed:
            value = fixed[name] if isinstance(fixed[name], Column) else F.lit(fixed[name])
        else:
            value = F.col(name) if name in about else F.lit(None)
        columns.append(value.cast(kind).alias(name))
    return keys.select(*columns)


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def grain_filter(grain: str) -> Column:
    """Changes whose key columns are just those of the grain."""
    has = {c: F.col(c).isNotNull() for c in GRAINS["source_product"]}
    return reduce(Column.__and__, (test if c in GRAINS[grain] else ~test for c, test in has.items()))


def _checks(order: Sequence[str], grains: Sequence[str]) -> dict[str, Column]:
    applied = reduce(Column.__or__, map(grain_filter, grains))
    rule = F.coalesce("rule", F.lit("NULL"))
    no_place = ~F.coalesce(F.col("rule").isin(*order), F.lit(False))
    return {
        "n": F.count(F.lit(1)),
        "no_place": F.max(F.when(no_place, rule)),
        "no_grain": F.max(F.when(~applied, rule)),
    }


def _refuse(seen: dict) -> int:
    if seen["no_place"] is not None:
        raise ValueError(f"rule without a place in the order: {seen['no_place']}")
    if seen["no_grain"] is not None:
        raise ValueError(f"change of a grain that is not applied, by rule {seen['no_grain']}")
    return seen["n"] or 0


def checked_rows(changes: DataFrame, order: Sequence[str], grains: Sequence[str]) -> int:
    """Number of changes; raises if one of them has a rule or a grain that would not be run.

    An aggregate over the changes alone, read on the driver: a check inside a join can be lost to
    filters that the optimizer infers from the join.
    """
    return _refuse(changes.agg(*(value.alias(name) for name, value in _checks(order, grains).items())).first().asDict())


def store_changes(
    changes: DataFrame, name: str = "changes", order: Sequence[str] = RULE_ORDER, grains: Iterable[str] = tuple(GRAINS)
) -> tuple[DataFrame, int]:
    """The changes, written, and their number; checked as by ``checked_rows`` in the job that writes them."""
    written, seen = materialise_seen(changes, name, **_checks(order, tuple(grains)))
    return written, _refuse(seen)


def gathered(changes: DataFrame, grain: str, order: Sequence[str], apart: bool = True) -> DataFrame:
    """The changes of one grain: its keys and an array of steps in the order of the rules."""
    step = F.struct(
        lookup(F.col("rule"), {rule: i for i, rule in enumerate(order)}).alias("position"),
        "from_date",
        "to_date",
        "only_flag",
        "new_flag",
    )
    steps = F.sort_array(F.collect_set(step)).alias("steps")
    of_grain = changes.where(grain_filter(grain))
    return group_apart(of_grain, GRAINS[grain], steps) if apart else of_grain.groupBy(*GRAINS[grain]).agg(steps)


def folded(steps: Column) -> Column:
    """The flag after the last step that concerns the row; NULL where none does."""
    updated_at = F.col("updated_at")

    def run(state: Column, s: Column) -> Column:
        after = s["from_date"].isNull() | (updated_at >= s["from_date"].cast("timestamp"))
        before = s["to_date"].isNull() | (updated_at < s["to_date"].cast("timestamp"))
        allowed = s["only_flag"].isNull() | (s["only_flag"] == state["flag"])
        hit = F.struct(s["new_flag"].alias("flag"), F.lit(True).alias("hit"))
        return F.when(after & before & allowed, hit).otherwise(state)

    start = F.struct(F.col("show_in_report").cast("string").alias("flag"), F.lit(False).alias("hit"))
    fold = F.aggregate(steps, start, run, lambda state: F.when(state["hit"], state["flag"]))
    # most rows have no steps
    return F.when(steps.isNotNull(), fold)


def merged(lists: Sequence[Column]) -> Column:
    """The steps of several grains in the order of the rules; NULL where there are none."""
    if len(lists) == 1:
        return lists[0]
    several = sum((name.isNotNull().cast("int") for name in lists), F.lit(0)) > 1
    both = F.sort_array(F.concat(*(F.coalesce(name, F.array()) for name in lists)))
    return F.when(several, both).otherwise(F.coalesce(*lists))


def joined_directly(table: DataFrame, changes: DataFrame, order: Sequence[str], grains: Sequence[str]) -> DataFrame:
    """``table`` with its outcome, by one broadcast per grain of a change-set of checked size."""
    names = []
    for grain in grains:
        name = f"_{grain}_changes"
        table = table.join(F.broadcast(gathered(changes, grain, order).withColumnRenamed("steps", name)), GRAINS[grain], "left")
        names.append(F.col(name))
    return table.withColumn("_outcome", folded(merged(names)))


def joined_in_place(
    table: DataFrame, stages: Sequence[tuple[DataFrame, Sequence[str]]], order: Sequence[str] = RULE_ORDER
) -> DataFrame:
    """``table`` with its outcome, from changes and their grains, stage by stage.

    For a table and changes in the same buckets of stations: nothing is shuffled, and no table is larger than a bucket
    where it is hashed.
    """
    names = []
    for changes, grains in stages:
        for grain in grains:
            name = f"_changes_{len(names)}"
            steps = gathered(changes, grain, order, apart=False).withColumnRenamed("steps", name)
            table = table.join(steps.hint("shuffle_hash"), GRAINS[grain], "left")
            names.append(F.col(name))
    return table.withColumn("_outcome", folded(merged(names)) if names else F.lit(None).cast("string"))


def grains_used(changes: DataFrame, grains: Sequence[str]) -> list[str]:
    """Those of the grains that have a change; the rows need no join for the others."""
    used = changes.agg(*(F.max(F.when(grain_filter(grain), grain)).alias(grain) for grain in grains)).first()
    return [grain for grain in used if grain]


def outcomes(table: DataFrame, changes: DataFrame, order: Sequence[str], grains: Sequence[str]) -> DataFrame:
    """``ROW_KEY`` and the flag afterwards, of the rows that a change concerns, once per key.

    What happens to a row depends on these few columns alone, so only they, and only those of the
    stations that are changed, are shuffled by the keys of each grain in use.
    """
    touched = materialise(changes.select("station_id").distinct(), "touched-stations")
    rows = table.select(*ROW_KEY).join(touched, "station_id", "left_semi").select(F.struct(*ROW_KEY).alias("row")).distinct()
    found = materialise(rows.select("row.*"), "touched-rows")
    lists = []
    for grain in grains_used(changes, grains):
        name = f"_{grain}_changes"
        found = found.join(gathered(changes, grain, order).withColumnRenamed("steps", name), GRAINS[grain], "left")
        lists.append(F.col(name))
    outcome = folded(merged(lists)) if lists else F.lit(None).cast("string")
    return found.withColumn("_outcome", outcome).where(F.col("_outcome").isNotNull()).select(*ROW_KEY, "_outcome")


def outcomes_in_place(table: DataFrame, stages: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``outcomes`` as by ``joined_in_place``."""
    found = joined_in_place(table.select(*ROW_KEY), stages)
    return found.where(F.col("_outcome").isNotNull()).select(*ROW_KEY, "_outcome").distinct()


def joined_by_outcome(table: DataFrame, changes: DataFrame, order: Sequence[str], grains: Sequence[str]) -> DataFrame:
    """``table`` with its outcome, by one join whatever the number of grains."""
    return joined_with(table, materialise(outcomes(table, changes, order, grains), "outcomes"))


def joined_with(table: DataFrame, found: DataFrame, hint: str | None = None) -> DataFrame:
    """``table`` with its outcome, from the ``outcomes`` found for it, which are one per key and so spread evenly."""
    found = found.select(*(F.col(c).alias(f"_of_{c}") for c in ROW_KEY), "_outcome")
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in ROW_KEY))
    return table.join(found.hint(hint) if hint else found, same, "left").select(*table.columns, "_outcome")


def apply_changes(
    table: DataFrame,
    changes: DataFrame,
    order: Sequence[str] = RULE_ORDER,
    grains: Iterable[str] = tuple(GRAINS),
    updated_by: int = refdata.UPDATED_BY_ID,
    broadcast_rows: int = BROADCAST_CHANGES,
    rows: int | None = None,
) -> DataFrame:
    """The price table as it is after one update per rule, run in ``order``.

    ``changes`` are counted first, so write out those that are costly to compute; ``rows`` is their number
    where ``store_changes`` has told it. Up to ``broadcast_rows``
    of them are sent to every executor, and the table is not shuffled at all. Beyond, the outcome is
    worked out on the few columns that decide it and the table takes part in one join, in which Spark
    splits hot keys.

    A change of a rule that ``order`` lacks, or of a grain that ``grains`` lacks, raises
    ValueError here instead of being ignored.
    """
    grains = tuple(grains)
    if not grains:
        raise ValueError("no grains to apply")
    few = (checked_rows(changes, order, grains) if rows is None else rows) <= broadcast_rows
    return with_outcome((joined_directly if few else joined_by_outcome)(table, changes, order, grains), table.columns, updated_by)


def with_outcome(result: DataFrame, columns: Sequence[str], updated_by: int = refdata.UPDATED_BY_ID) -> DataFrame:
    """The columns as they are after the outcome, which a row has where a change concerned it."""
    touched = F.col("_outcome").isNotNull()
    written = {
        "show_in_report": F.coalesce("_outcome", "show_in_report"),
        "updated_by_id": F.when(touched, F.lit(updated_by)).otherwise(F.col("updated_by_id")).cast("bigint"),
    }
    return result.select(*(written[c].alias(c) if c in written else F.col(c) for c in columns))


def change_text(changes: DataFrame, *kept: str) -> DataFrame:
    """One line of text per change, for a report: rule, the columns to keep, line."""

    def condition(name: str, template: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.format_string(template, F.col(name).cast("string")))

    return changes.select(
        "rule",
        *kept,
        F.concat_ws(
            " and ",
            condition("station_id", "station_id = %s"),
            condition("source", "source = '%s'"),
            condition("product_id", "product_id = %s"),
            condition("from_date", "updated_at >= %s"),
            condition("to_date", "updated_at < %s"),
            condition("only_flag", "show_in_report = '%s'"),
        ).alias("line"),
    )


def change_report(changes: DataFrame, lines: int = 50, between: str = "; ") -> DataFrame:
    """(rule, station_id, part, changes, text): the lines of a rule about a station in order, joined.

    A text has ``lines`` lines at most; longer reports go on in the next part (from 0), so no text
    grows with the number of changes and no line is lost.
    """
    order = Window.partitionBy("rule", "station_id").orderBy("line")
    each = change_text(changes, "station_id").withColumn("place", F.row_number().over(order) - 1)
    part = F.floor(F.col("place") / lines).cast("int").alias("part")
    in_order = F.array_sort(F.collect_list(F.struct("place", "line")))
    return each.groupBy("rule", "station_id", part).agg(
        F.count(F.lit(1)).alias("changes"), F.array_join(F.transform(in_order, lambda x: x["line"]), between).alias("text")
    )
