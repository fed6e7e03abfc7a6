"""Which objects of a listing are meant: prefixes, patterns of base names, extensions, folders with a suffix.

A listing is any table with a column of names: files that Spark lists, or an inventory that a store writes, which may be of
any size. All rules are columns, so a selection is one pass, without a shuffle but for its order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import stripped

MODES = ("all", "only_fp", "exclude_fp")


def prefix(value: str | None) -> str:
    """A prefix without white space and slashes at its ends, and with one slash behind it; nothing stays nothing."""
    bare = (value or "").strip().strip("/")
    return f"{bare}/" if bare else ""


def glob_pattern(glob: str) -> str:
    """A shell pattern of base names as a regular expression: * and ? are any letters, [ab] and [!ab] one of a set."""
    out, at = "", 0
    while at < len(glob):
        c = glob[at]
        end = glob.find("]", at + 2 + (glob[at + 1 : at + 2] == "!")) if c == "[" else -1
        if c == "[" and end > 0:
            inner = glob[at + 1 : end]
            inside = "".join(x if x == "-" else "\\" + x if not x.isalnum() else x for x in inner.removeprefix("!"))
            out += ("[^" if inner.startswith("!") else "[") + inside + "]"
            at = end + 1
            continue
        out += "[\\s\\S]*" if c == "*" else "[\\s\\S]" if c == "?" else c if c.isalnum() else "\\" + c
        at += 1
    return rf"\A{out}\z"


def base_name(name: Column) -> Column:
    """The last component of a name, slashes at its end aside."""
    return F.regexp_extract(F.rtrim(name, F.lit("/")), r"[^/]*\z", 0)


def extension(name: Column) -> Column:
    """Extension of the base name in lower case, without its dot; empty if it has none, as hidden names without a further dot."""
    return F.lower(F.regexp_extract(base_name(name), r"(?s)\A.+\.([^.]+)\z", 1))


def is_placeholder(name: Column) -> Column:
    """Objects that stand for a folder."""
    return name.endswith("/")


def below(name: Column, value: str | None) -> Column:
    """Whether a name begins with a prefix, tidied."""
    bare = prefix(value)
    return name.startswith(bare) if bare else F.lit(True)


def relative(name: Column, value: str | None) -> Column:
    """A name without its prefix."""
    bare = prefix(value)
    return F.when(name.startswith(bare), F.substring(name, F.lit(len(bare) + 1), F.char_length(name))).otherwise(name) if bare else name


def selected(listing: DataFrame, name: str, under: str | None = None, glob: str | None = None, extensions: set[str] | None = None, hidden: bool = False) -> DataFrame:
    """Rows of ``listing`` whose name is below ``under``, no placeholder, whose base name fits ``glob`` and has an extension.

    Base names that begin with ``._`` are left out unless ``hidden``; null names always are. An empty listing stays empty.
    """
    c = F.col(name)
    kept = listing.where(c.isNotNull() & below(c, under) & ~is_placeholder(c))
    kept = kept if hidden else kept.where(~base_name(c).startswith("._"))
    kept = kept.where(base_name(c).rlike(glob_pattern(glob))) if glob and glob != "*" else kept
    return kept.where(extension(c).isin({e.lower().lstrip(".") for e in extensions})) if extensions is not None else kept


def in_mode(name: Column, mode: str, under: str | None = None, suffix: str = "_fp") -> Column:
    """Whether a name's folders below the prefix, not its base name, end with ``suffix``, as the mode has it; odd modes raise."""
    if (wanted := mode.lower()) not in MODES:
        raise ValueError(f"no mode {mode!r}; there are {', '.join(MODES)}")
    folders = F.split(relative(name, under), "/")
    marked = F.exists(F.slice(folders, F.lit(1), F.size(folders) - 1), lambda p: p.endswith(suffix))
    return F.lit(True) if wanted == "all" else marked if wanted == "only_fp" else ~marked


def or_raise(df: DataFrame, message: str) -> DataFrame:
    """``df``; reading it raises if it has no rows."""
    first = df.columns[0]
    none = df.limit(1).agg(F.count(F.lit(1)).alias("_n")).where("_n = 0")
    said = none.select(F.raise_error(F.concat(F.lit(message), F.col("_n").cast("string").substr(0, 0))).cast(df.schema[first].dataType).alias(first), *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields[1:]])
    return df.unionByName(said)


def inputs(listing: DataFrame, name: str, under: str, glob: str = "*", recursive: bool = True, mode: str = "all", suffix: str = "_fp") -> DataFrame:
    """The files to be processed, in the order of their names; none at all raises when they are read."""
    kept = selected(listing, name, under, glob, hidden=True).where(in_mode(F.col(name), mode, under, suffix))
    kept = kept if recursive else kept.where(~relative(F.col(name), under).contains("/"))
    return or_raise(kept, f"no files matched {glob} in {prefix(under)} ({mode})").orderBy(name)


def asked_names(names: DataFrame, name: str) -> DataFrame:
    """Distinct names of a list, without white space at their ends; blank ones do not count."""
    return names.select(stripped(F.col(name)).alias(name)).where(F.col(name) != "").distinct()
