"""Column predicates for the several notions of empty, true and failed, and scores of validation labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Synonyms of validation labels.
LABELS = {
    "accepted": ["accept", "accepted"],
    "somewhat": ["somewhat_accept", "somewhat accept", "somewhat-accept", "partial"],
    "rejected": ["reject", "rejected"],
    "corrected": ["corrected", "correction"],
    "unsure": ["unsure", "unknown"],
}


def populated(c: Column, kind: str = "string") -> Column:
    """Not null, not blank, not an empty container; zero and false are populated."""
    if kind == "string":
        return c.isNotNull() & (F.trim(c) != "")
    if kind in ("array", "map"):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def populated_variant(v: Column) -> Column:
    """The same for a VARIANT value, by its type."""
    kind = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    return v.isNotNull() & F.coalesce(F.when(kind == "VOID", False).when(kind == "STRING", F.trim(text) != "").when(text.isin("{}", "[]"), False).otherwise(True), F.lit(False))


def _flag(c: Column, *spelled: str) -> Column:
    """Text in one of its spellings, in any case; a boolean is itself, a number true unless zero."""
    text = F.lower(F.trim(c.cast("string")))
    number = text.try_cast("double")
    return F.when(F.typeof(c).isin("string", "void"), text.isin(*spelled)).when(number.isNotNull(), number != 0).otherwise(text.isin("true"))


def truthy(c: Column) -> Column:
    """Of text 1, true, yes and y, in any case; of numbers all but zero; null is false."""
    return F.coalesce(_flag(c, "1", "true", "yes", "y"), F.lit(False))


def row_failed(failed: Column, status: Column | None = None) -> Column:
    """A failed flag, as text in any of its spellings or as a number; the status only where there is no flag."""
    flag = _flag(failed, "1", "true", "yes", "y", "failed", "error")
    by_status = F.lower(F.trim(status)).isin("failed", "error", "missing") if status is not None else F.lit(False)
    return F.coalesce(F.when(failed.isNotNull(), flag), by_status, F.lit(False))


def real_number(v: Column) -> Column:
    """A VARIANT's number as double; null for strings, booleans and containers."""
    kind = F.schema_of_variant(v)
    return F.when(kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), F.try_variant_get(v, "$", "double"))


def parsed_number(v: Column) -> Column:
    """The same, but numeric strings count."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "double")).otherwise(real_number(v))


def label_class(label: Column) -> Column:
    """The canonical label of a synonym, in any case; null for other labels."""
    low = F.lower(F.trim(label))
    out = F.when(F.lit(False), "")
    for name, synonyms in LABELS.items():
        out = out.when(low.isin(*synonyms), name)
    return out


def report_score(label: Column) -> Column:
    """Report convention: accepted and somewhat 1, rejected, unsure and corrected 0, others null."""
    c = label_class(label)
    return F.when(c.isin("accepted", "somewhat"), 1.0).when(c.isin("rejected", "unsure", "corrected"), 0.0)


def dashboard_score(label: Column) -> Column:
    """Dashboard convention: accepted 1, somewhat 0.5, rejected and corrected 0; unsure and others do not count."""
    c = label_class(label)
    return F.when(c == "accepted", 1.0).when(c == "somewhat", 0.5).when(c.isin("rejected", "corrected"), 0.0)


def schema_field(path: Column, identifiers: list[str], metadata: list[str], fragments: list[str]) -> Column:
    """Class of a dotted column name: identifier, metadata (by name, leaf or fragment), or schema."""
    from quillspark.functions.text import field_name, leaf

    name, last = field_name(path), field_name(leaf(path))
    has = F.exists(F.array(*map(F.lit, fragments)), lambda f: F.contains(name, f)) if fragments else F.lit(False)
    return F.when(name.isin(identifiers) | last.isin(identifiers), "identifier").when(name.isin(metadata) | last.isin(metadata) | has, "metadata").otherwise("schema")
