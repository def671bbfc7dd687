"""Text expressions. All of them stay inside generated JVM code; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqlake.vocab import LIST_SEPARATOR, REDACTED


def strip(c: Column) -> Column:
    """Drop leading and trailing white space, line breaks and tabs included."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def is_blank(c: Column) -> Column:
    return null_to_blank(c) == ""


def or_else(c: Column, fallback: str) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(fallback))


def _words_joined_by(c: Column, mark: str) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", mark), F.lit(mark))


def normalize_attribute_name(c: Column) -> Column:
    return _words_joined_by(null_to_blank(c), "_")


def slugify(c: Column) -> Column:
    return or_else(_words_joined_by(c, "-"), "query")


def utc_stamp(ts: Column | None = None) -> Column:
    """Compact UTC stamp of a timestamp (default: now) such as 20260131T235959Z."""
    at = F.current_timestamp() if ts is None else ts
    shifted = F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz"))
    return F.date_format(shifted, "yyyyMMdd'T'HHmmss'Z'")


def merge_source_value(existing: Column, new: Column) -> Column:
    """Append a source to a joined list unless it is already there; blanks are dropped."""
    known = F.filter(F.split(existing, r" \| "), lambda v: v != "")
    grown = F.when(F.array_contains(known, new), known).otherwise(F.array_append(known, new))
    return F.array_join(grown, LIST_SEPARATOR)


def path_parts(path: Column) -> Column:
    """Path components without the scheme. Compared as arrays they sort folder by folder."""
    return F.split(F.regexp_replace(path, "^[a-z0-9]+:/*", "/"), "/")


def file_name(path: Column) -> Column:
    return F.element_at(path_parts(path), -1)


def source_dataset_name(path: Column, root: str) -> Column:
    """First folder below the root; `root` for files in it; the parent folder's name elsewhere."""
    parts = path_parts(path)
    base = path_parts(F.lit(root.rstrip("/")))
    depth = F.size(base)
    below = F.slice(parts, 1, depth) == base
    return (
        F.when(~below, F.element_at(parts, -2))
        .when(F.size(parts) == depth + 1, F.lit("root"))
        .otherwise(F.get(parts, depth))
    )


def redact_params(params: Column) -> Column:
    return F.transform_values(
        params, lambda k, v: F.when(k == "api_key", F.lit(REDACTED)).otherwise(v)
    )


def _decode(c: Column) -> Column:
    # A percent sign that starts no escape stands for itself.
    return F.url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def redact_url(url: Column) -> Column:
    """Replace the api_key value in the query string; the other parameters are re-encoded."""
    head = F.regexp_extract(url, r"^([^?#]*)", 1)
    head = F.concat(F.lower(F.regexp_extract(head, "^([A-Za-z][A-Za-z0-9+.-]*:)?", 1)),
                    F.regexp_replace(head, "^[A-Za-z][A-Za-z0-9+.-]*:", ""))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"#(.+)$", 1)

    def rewrite(pair: Column) -> Column:
        key = _decode(F.substring_index(pair, "=", 1))
        value = _decode(F.regexp_extract(pair, r"^[^=]*=(.*)$", 1))
        shown = F.when(key == "api_key", F.lit(REDACTED)).otherwise(value)
        return F.concat(_encode(key), F.lit("="), _encode(shown))

    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    rebuilt = F.array_join(F.transform(pairs, rewrite), "&")
    return F.concat(
        head,
        F.when(rebuilt != "", F.concat(F.lit("?"), rebuilt)).otherwise(""),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )
