"""Column expressions over registry records (JSON parsed to VARIANT)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt.functions.prices import lookup

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# first and last second of the years 1 to 9999
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799


def path_or_default(record: Column, path: str, default: str | None = "") -> Column:
    """Text at a path: ``default`` where the path is missing, NULL where it holds a JSON null."""
    node = F.try_variant_get(record, path, "variant")
    return F.when(node.isNull(), F.lit(default)).otherwise(F.try_variant_get(record, path, "string"))


def list_text(record: Column, path: str, default: str | None = "", between: str = ", ") -> Column:
    """As ``path_or_default``, but a list gives the texts of its entries in order, joined.

    An entry that is an object gives its field ``value``; entries that are null or have no text are left out, so
    a list without any gives ''.
    """
    items = F.try_variant_get(record, path, "array<variant>")

    def text(item: Column) -> Column:
        own, inner = (F.try_variant_get(item, at, "string") for at in ("$", "$.value"))
        return F.when(F.schema_of_variant(item).startswith("OBJECT"), inner).otherwise(own)

    texts = F.filter(F.transform(items, text), lambda t: t.isNotNull())
    return F.when(items.isNotNull(), F.array_join(texts, between)).otherwise(path_or_default(record, path, default))


def epoch_text(millis: Column) -> Column:
    """Epoch milliseconds given as text, as UTC date and time text.

    The last three characters are cut off. What is no number then gives ''; NULL, '' and 0
    stay as they are.
    """
    cut = F.length(millis) - 3
    seconds = F.when(cut > 0, F.substring(millis, F.lit(1), cut)).try_cast("bigint")
    inside = F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds)
    stamp = F.date_format(F.timestamp_seconds(inside), TIME_FORMAT)
    return F.when(millis.isNull() | millis.isin("", "0"), millis).otherwise(F.coalesce(stamp, F.lit("")))


def director_name(kind: Column, surname: Column, name: Column, patronymic: Column, manager: Column) -> Column:
    """Person's name for an individual, the manager's for a legal entity, else ''."""
    blank = F.lit("")
    person = F.concat_ws(" ", *(F.coalesce(p, blank) for p in (surname, name, patronymic)))
    return F.when(kind == "INDIVIDUAL", F.trim(person)).when(kind == "LEGAL", manager).otherwise(blank)


def translate_code(code: Column, names: Mapping[str, str], mode: str = "strict") -> Column:
    """Name of a code; '' gives NULL. An unknown code fails (strict) or gives NULL (null)."""
    if mode not in ("strict", "null"):
        raise ValueError(f"unknown mode {mode!r}")
    name = lookup(code, names)
    if mode == "null":
        return name
    problem = F.concat(F.lit("unknown code: "), F.coalesce(code, F.lit("NULL")))
    return F.when(code.isNotNull() & (code == ""), F.lit(None)).otherwise(
        F.coalesce(name, F.raise_error(problem).cast("string"))
    )
