"""Company registry: look up ids and flatten the records found."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from forecourt import refdata
from forecourt.functions.registry import director_name, epoch_text, list_text, path_or_default, translate_code


def registry_lookup(ids: DataFrame, registry: DataFrame, order: str = "loaded") -> DataFrame:
    """(itn, payload) of every distinct id; payload is NULL where nothing is on file.

    Of several records of an id the one with the greatest ``order`` counts, the last that was loaded; records
    without it come before all others. Equally late ones, and those of a registry without that
    column, go by text, the greatest last.
    """
    wanted = ids.select("itn").distinct()
    late = [F.col(order)] if order in registry.columns else []
    last = F.max_by("payload", F.struct(*late, "payload")).alias("payload")
    records = registry.join(wanted, "itn", "left_semi").groupBy("itn").agg(last)
    return wanted.join(records, "itn", "left")


def parse_records(found: DataFrame, mode: str = "null", counts: Observation | None = None) -> DataFrame:
    """Parse each payload once; all paths then read the binary form.

    A payload that is no JSON fails (strict) or gives NULL (null). The pass that parses also fills
    ``counts``: ids, missing (nothing on file), malformed (no JSON).
    """
    parse = F.parse_json if mode == "strict" else F.try_parse_json
    parsed = found.withColumn("record", parse(F.col("payload")))
    if counts is not None:
        empty, none = F.col("payload").isNull(), F.col("record").isNull()
        parsed = parsed.observe(
            counts, F.count(F.lit(1)).alias("ids"), F.count_if(empty).alias("missing"), F.count_if(none & ~empty).alias("malformed")
        )
    return parsed.drop("payload")


def registry_flatten(found: DataFrame, mode: str = "strict", counts: Observation | None = None) -> DataFrame:
    """One typed row per looked-up id. ``mode`` says what an unknown code or a broken record does.

    A field that holds a list gives the texts of its entries, see ``list_text``. ``counts`` as in ``parse_records``.
    """
    record = F.col("record")

    def at(path: str, default: str | None = ""):
        return path_or_default(record, f"$[0].{path}", default)

    def listed(path: str):
        return list_text(record, f"$[0].{path}")

    fields = parse_records(found, mode, counts).select(
        "itn",
        at("value").alias("name"),
        at("data.type").alias("kind"),
        at("data.address.unrestricted_value").alias("address"),
        listed("data.phones").alias("phone"),
        listed("data.emails").alias("email"),
        at("data.state.status").alias("state"),
        at("data.state.actuality_date", None).alias("millis"),
        listed("data.okved").alias("okved"),
        listed("data.kpp").alias("kpp"),
        at("data.fio.surname").alias("surname"),
        at("data.fio.patronymic").alias("patronymic"),
        at("data.fio.name").alias("first_name"),
        at("data.management.name").alias("manager"),
    )
    return fields.select(
        "itn",
        "name",
        translate_code(F.col("kind"), refdata.LEGAL_FORMS, mode).alias("type"),
        "address",
        "phone",
        "email",
        translate_code(F.col("state"), refdata.COMPANY_STATUSES, mode).alias("status_itn"),
        epoch_text(F.col("millis")).alias("updated_date"),
        "okved",
        "kpp",
        director_name(
            F.col("kind"), F.col("surname"), F.col("first_name"), F.col("patronymic"), F.col("manager")
        ).alias("full_name_director"),
    )
