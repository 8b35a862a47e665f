"""Columns over arrays, maps, JSON, hashes, URLs and binary values, and nested configuration."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def listed(value: Column, chars: int = 120, is_array: bool = True, most: int | None = None) -> Column:
    """An array of cut, non-blank strings from an array or a single string; null gives an empty one."""
    array = value if is_array else F.array(value)
    out = F.transform(F.filter(F.coalesce(array, F.array().cast("array<string>")), lambda x: x.isNotNull() & (F.trim(x) != "")), lambda x: F.substring(x, 1, chars))
    return F.slice(out, 1, most) if most else out


def json_object(text: Column) -> Column:
    """The JSON object in a text that may have a fence or words around it, as text; null if there is none."""
    bare = F.trim(F.regexp_replace(text, r"(?s)^\s*```(?:json)?\s*|\s*```\s*$", ""))
    inner = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    valid = lambda x: F.when(F.is_valid_utf8(x) & F.try_parse_json(x).isNotNull() & F.startswith(F.ltrim(x), F.lit("{")), x)
    return F.coalesce(valid(bare), valid(F.nullif(inner, F.lit(""))))


def one_of(value: Column, allowed: list[str], default: str) -> Column:
    """A value folded to lower case if it is one of those allowed, else ``default``."""
    x = F.lower(F.trim(value))
    return F.when(x.isin(allowed), x).otherwise(F.lit(default))


def first_present(*columns: Column) -> Column:
    """The first that is neither null, empty nor 0, as a chain of ``or`` takes it."""
    return F.coalesce(*(F.when(~c.cast("string").isin("", "0", "0.0", "false"), c) for c in columns))


def short_hash(value: Column, length: int = 8) -> Column:
    return F.substring(F.sha1(F.coalesce(value, F.lit(""))), 1, length)


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def grid_key(page: Column, box: Column, grid: int = 12, text: Column | None = None) -> Column:
    """A key that is equal for boxes at about the same place of a page."""
    cells = [(F.round(F.get(box, i) / grid) * grid).cast("long").cast("string") for i in range(4)]
    return F.concat_ws(":", page.cast("string"), *cells, *([F.substring(text, 1, 40)] if text is not None else []))


def redact(url: Column) -> Column:
    """A URL without user, password and values of secret-looking parameters."""
    no_user = F.regexp_replace(url, r"(?<=://)[^/@\s]+@", "***@")
    return F.regexp_replace(no_user, r"(?i)((?:key|token|secret|password|sig)[a-z_]*=)[^&\s]+", "$1***")


def data_uri(content: Column, mime: str = "image/jpeg") -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), F.base64(content))


def merged_maps(first: Column, second: Column) -> Column:
    """Both maps as one; where both have a key, the second's value. Null counts as empty."""
    kept = F.map_filter(first, lambda k, _: ~F.coalesce(F.map_contains_key(second, k), F.lit(False)))
    return F.coalesce(F.map_concat(kept, second), second, first)


def host(url: Column) -> Column:
    """The host of a URL in lower case; null where there is none."""
    return F.lower(F.nullif(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


def registered_host(url: Column) -> Column:
    """The last two labels of the host."""
    labels = F.split(F.regexp_replace(host(url), r"^www\.", ""), r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), F.lit(2)), ".")


def same_host(a: Column, b: Column) -> Column:
    return F.coalesce(registered_host(a) == registered_host(b), F.lit(False))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def filename_of(url: Column, fallback: str = "download") -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(url_path(url), r"([^/]+)$", 1), F.lit("")), F.lit(fallback))


def is_noise_url(url: Column, domains: list[str], parts: list[str]) -> Column:
    """Whether the host contains one of the domains, or the URL one of the parts."""
    h, u = F.coalesce(host(url), F.lit("")), F.lower(F.coalesce(url, F.lit("")))
    tests = [F.contains(h, F.lit(d)) for d in domains] + [F.contains(u, F.lit(p)) for p in parts]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def is_pdf_url(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_replace(url, "#.*$", "")).rlike(r"^[a-z][a-z0-9+.-]*://[^/]*/.*\.pdf"), F.lit(False))


def is_pdf_content(content: Column) -> Column:
    return F.coalesce(F.hex(F.substring(content, 1, 4)) == "25504446", F.lit(False))


def infer_format(path: Column) -> Column:
    return F.when(F.lower(path).rlike(r"\.html?$"), F.lit("html")).otherwise(F.lit("pdf"))


def traceable_link(href: Column, label: Column, authorities: list[str], exclude: str) -> Column:
    """Whether a link leads to a source: no anchor, script or address, not excluded, and a page or a named authority."""
    h, t = F.trim(F.coalesce(href, F.lit(""))), F.trim(F.coalesce(label, F.lit("")))
    both = F.lower(F.concat_ws(" ", t, h))
    named = reduce(lambda a, b: a | b, (F.contains(both, F.lit(a)) for a in authorities), F.lit(False))
    labelled = reduce(lambda a, b: a | b, (F.contains(F.lower(t), F.lit(a)) for a in authorities), F.lit(False))
    web = F.lower(h).rlike("^https?://")
    bare = F.btrim(url_path(h), F.lit("/")) == ""
    out = F.when((h == "") | h.rlike("^(#|javascript:|mailto:|tel:)"), False).when(both.rlike(f"(?i){exclude}"), False)
    return out.when(F.lower(h).startswith("file:"), labelled).when(web, ~bare | named).otherwise(named)


def deep_merge(base: dict[str, Any], override: dict[str, Any]) -> dict[str, Any]:
    """Nested configuration: the override wins, dictionaries are merged."""
    out = dict(base)
    for key, value in override.items():
        out[key] = deep_merge(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def dotted(config: dict[str, Any], path: str, default: Any = None) -> Any:
    """A value of nested configuration by a dotted path."""
    node: Any = config
    for part in path.split("."):
        if not isinstance(node, dict) or part not in node:
            return default
        node = node[part]
    return node
