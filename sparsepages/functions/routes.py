"""Ordered address templates as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORED = "ignored"


@dataclass(frozen=True)
class Route:
    """One template, e.g. ``things/{id}``.

    A ``{name}`` stands for one path segment (``{*name}`` for all that is left)
    and may be left out when ``defaults`` names it; a default of ``None`` means
    optional without a value.
    """

    name: str
    template: str
    defaults: Mapping[str, str | None] = field(default_factory=dict)
    ignore: bool = False


# The route table, in matching order.
DEFAULT_ROUTES = (
    Route("Resource", "{resource}.axd/{*pathInfo}", ignore=True),
    Route("Comic", "comics/{id}", {"controller": "comic", "action": "Index", "id": None}),
    Route("Default", "{controller}/{action}/{id}", {"controller": "Home", "action": "Index", "id": None}),
)

_PARAM = re.compile(r"\{(\*?)(\w+)\}")


def _segment_regex(segment: str, names: list[str]) -> str:
    out, at = "", 0
    for m in _PARAM.finditer(segment):
        names.append(m.group(2))
        out += re.escape(segment[at : m.start()]) + "([^/]+)"
        at = m.end()
    return out + re.escape(segment[at:])


def _literal(segment: Column, text: str) -> Column:
    """Equal but for the case of ASCII letters; other letters that lower to the same are longer in bytes."""
    same = F.lower(segment) == text.lower()
    return same & (F.octet_length(segment) == len(text.encode()))


def _fits(route: Route, segments: Column, count: Column) -> tuple[Column, dict[str, Column]]:
    """Does the template fit the segments of a path, and which values do its parameters take?

    ``count`` is the number of segments without an empty one at the end. Only
    segments that mix a parameter with other text are matched by a pattern.
    """
    parts = route.template.split("/")
    last = _PARAM.fullmatch(parts[-1])
    rest = last.group(2) if last and last.group(1) else None
    if rest:
        parts.pop()
    # Only a run of defaulted parameters at the end may be left out.
    required = len(parts)
    while required and (m := _PARAM.fullmatch(parts[required - 1])) and m.group(2) in route.defaults:
        required -= 1
    if rest and required < len(parts):
        raise ValueError(f"parameters before {{*{rest}}} cannot have defaults: {route.template!r}")

    test = F.size(segments) >= required if rest else count.between(required, len(parts))
    values: dict[str, Column] = {}
    for i, part in enumerate(parts):
        segment = F.get(segments, F.lit(i))
        whole, names = _PARAM.fullmatch(part), []
        pattern = "(?is)^" + _segment_regex(part, names) + "\\z"
        if whole:
            good, values[whole.group(2)] = segment != "", segment
        elif names:
            good = segment.rlike(pattern)
            values |= {name: F.regexp_extract(segment, pattern, names.index(name) + 1) for name in names}
        else:
            good = _literal(segment, part)
        test = test & (good if i < required else (count <= i) | good)
    if rest:
        values[rest] = F.array_join(F.slice(segments, required + 1, F.greatest(F.size(segments) - required, F.lit(0))), "/")
    return F.coalesce(test, F.lit(False)), values


def path_segments(path: Column) -> Column:
    return F.split(path, "/")


def url_path(url: Column) -> Column:
    """Path of an absolute or site-relative address: no host, query, fragment or leading slash."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?/?([^?#]*)", 1)
    decoded = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(path, F.lit("%")), F.coalesce(decoded, path)).otherwise(path)


def route_match(
    path: Column,
    routes: Sequence[Route] = DEFAULT_ROUTES,
    outputs: Sequence[str] = ("controller", "action", "id"),
    segments: Column | None = None,
) -> Column:
    """Struct of ``route`` and the route values; first template that fits wins.

    An ignored path gets the route name ``ignored`` and no values; a path that
    fits nothing gets NULL throughout. ``segments`` hands in ``path_segments`` of
    the path, so that it is split once for all templates.
    """
    segments = path_segments(path) if segments is None else segments
    ends_empty = F.element_at(segments, -1) == ""
    count = F.size(segments) - ends_empty.cast("int")
    chain = None
    for route in routes:
        hit, values = _fits(route, segments, count)
        fields = [F.lit(IGNORED if route.ignore else route.name).alias("route")]
        for name in outputs:
            value = F.lit(None).cast("string")
            if not route.ignore:
                value = F.lit(route.defaults.get(name)).cast("string")
                if name in values:
                    value = F.coalesce(F.nullif(values[name], F.lit("")), value)
            fields.append(value.alias(name))
        result = F.struct(*fields)
        chain = F.when(hit, result) if chain is None else chain.when(hit, result)
    return chain
