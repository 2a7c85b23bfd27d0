"""File names, member paths, content hashes and stable document ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_scheme(path: Column) -> Column:
    """``file:/a``, ``file:///a`` and ``hdfs://host/a`` -> ``/a``."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def file_extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r"(\.[^.]*)$", 1))


def clean_member(name: Column) -> Column:
    """Member path with ``/`` separators and ``.`` / inner ``..`` steps resolved."""
    slashed = F.regexp_replace(name, r"\\", "/")
    steps = F.filter(F.split(slashed, "/"), lambda s: (s != "") & (s != "."))
    folded = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, step: F.when(
            (step == "..") & (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1)) != ".."),
            F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))),
        ).otherwise(F.concat(done, F.array(step))),
    )
    return F.concat(F.when(slashed.startswith("/"), "/").otherwise(""), F.array_join(folded, "/"))


def is_wanted_member(name: Column) -> Column:
    """Only match documents and register files are taken from archives."""
    return F.lower(name).rlike(r"\.(json|csv)$")


def member_is_safe(name: Column) -> Column:
    """Wanted, relative, and not leaving the archive root."""
    cleaned = clean_member(name)
    return is_wanted_member(cleaned) & ~cleaned.startswith("/") & ~cleaned.startswith("../") & (cleaned != "..")


def versioned_name(name: Column, sha256: Column, first_sha256: Column) -> Column:
    """The plain name for the first content seen under it, ``stem__<12 hex>.ext`` for any other."""
    suffixed = F.concat(file_stem(name), F.lit("__"), F.substring(sha256, 1, 12), F.regexp_extract(name, r"(\.[^.]*)$", 1))
    return F.when(sha256 == first_sha256, name).otherwise(suffixed)


def _canonical(raw_json: Column) -> Column:
    """Attributes that identify a match, as compact JSON with sorted keys and explicit nulls.

    A variant keeps object keys sorted, so the event object is canonical whatever its source order.
    """
    event = F.try_parse_json(F.get_json_object(raw_json, "$.info.event"))
    texts = lambda path: F.from_json(F.get_json_object(raw_json, path), "array<string>")
    picked = F.struct(
        F.get_json_object(raw_json, "$.info.city").alias("city"),
        F.get_json_object(raw_json, "$.meta.data_version").alias("data_version"),
        texts("$.info.dates").alias("dates"),
        event.alias("event"),
        F.coalesce(F.sort_array(texts("$.info.teams")), F.array().cast("array<string>")).alias("teams"),
        F.get_json_object(raw_json, "$.info.venue").alias("venue"),
    )
    return F.to_json(picked, {"ignoreNullFields": "false"})


def stable_id(raw_json: Column, path: Column) -> Column:
    """Struct ``(match_id, match_id_rule)``: an all-digit file stem, else a hash of identifying attributes."""
    stem = file_stem(path)
    numbered = F.coalesce(stem.rlike("^[0-9]+$"), F.lit(False))
    hashed = F.concat(F.lit("fallback_"), F.substring(F.sha2(_canonical(raw_json), 256), 1, 32))
    return F.struct(
        F.when(numbered, stem).otherwise(hashed).alias("match_id"),
        F.when(numbered, F.lit("filename_stem")).otherwise(F.lit("canonical_sha256")).alias("match_id_rule"),
    )
