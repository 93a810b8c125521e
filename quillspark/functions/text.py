"""Text, hash, JSON and time expressions."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPEN, _CLOSE = re.compile(r"<private\b[^>]*>", re.I), re.compile(r"</private\s*>", re.I)


def trimmed(x: Column) -> Column:
    """Without white space at the ends (all of it, not only spaces)."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def truncated(x: Column, n: int) -> Column:
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit("…"))).otherwise(x)


def collapsed(x: Column) -> Column:
    return trimmed(F.regexp_replace(F.lower(x), r"\s+", " "))


def tokens(x: Column) -> Column:
    """Lower-cased runs of letters a-z and digits, in order, repeats included."""
    return F.array_remove(F.split(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+"), "")


def token_set(x: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(x), "[^a-z0-9]+"), lambda t: t != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Resemblance of two token sets; two empty ones are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def short_id(x: Column) -> Column:
    return F.substring(F.replace(x, F.lit("-"), F.lit("")), 1, 8)


def fnv1a(x: Column) -> Column:
    """32-bit FNV-1a over the code points of the basic plane, as 8 hexadecimal digits."""
    step = lambda h, c: (h.bitwiseXOR(F.ascii(c).cast("bigint")) * F.lit(16777619).cast("bigint")).bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
    return F.lpad(F.lower(F.hex(F.aggregate(F.filter(F.split(x, ""), lambda c: c != ""), F.lit(2166136261).cast("bigint"), step))), 8, "0")


def poly31(x: Column) -> Column:
    """31-polynomial hash over UTF-16 code units in 32 signed bits, as ``fallback:`` and signed hexadecimal digits."""
    more = lambda h, u: (h * 31 + u).bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
    high = lambda c: F.lit(0xD800) + F.shiftright(c - 0x10000, 10)
    low = lambda c: F.lit(0xDC00) + (c - 0x10000).bitwiseAND(F.lit(0x3FF).cast("bigint"))
    points = F.transform(F.filter(F.split(x, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("bigint"))
    units = F.flatten(F.transform(points, lambda c: F.when(c < 0x10000, F.array(c)).otherwise(F.array(high(c), low(c)))))
    h = F.aggregate(units, F.lit(0).cast("bigint"), more)
    signed = F.when(h >= 0x80000000, h - 0x100000000).otherwise(h)
    return F.concat(F.lit("fallback:"), F.when(signed < 0, "-").otherwise(""), F.lower(F.hex(F.abs(signed))))


def objective_key(id_: Column, project: Column, content: Column) -> Column:
    """An objective's id, or where it has none a hash of its project and text."""
    own = F.nullif(id_.cast("string"), F.lit(""))
    return F.coalesce(own, F.concat(F.lit("text:"), fnv1a(F.concat(F.coalesce(project, F.lit("")), F.lit("|"), F.coalesce(content, F.lit(""))))))


def epoch_ms(x: Column) -> Column:
    """Milliseconds since the epoch of a time given as text, null where it is none."""
    return F.unix_millis(F.try_to_timestamp(x))


def json_fields(x: Column) -> Column:
    """A JSON object's fields as a map of variants; empty where there is no object."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(x), "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))


def json_merged(a: Column, b: Column) -> Column:
    """The object ``a`` with the fields of ``b``, which replace its own (one level deep)."""
    old, new = json_fields(a), json_fields(b)
    return F.to_json(F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new))


def json_without(x: Column, key: str) -> Column:
    return F.to_json(F.map_filter(json_fields(x), lambda k, _: k != key))


def without_fence(x: Column) -> Column:
    """From the first brace to the last, as a model's reply may be fenced or chatty."""
    return F.regexp_extract(x, r"(?s)(\{.*\})", 1)


def redact_private(text: str | None) -> tuple[str | None, bool]:
    """Text with each outermost private span replaced, and whether there was one.

    Tags may have attributes and nest.  A span that is never closed stays, with
    everything after it.
    """
    if not text or "<" not in text:
        return text, False
    tags = sorted([(m.start(), m.end(), 1) for m in _OPEN.finditer(text)] + [(m.start(), m.end(), -1) for m in _CLOSE.finditer(text)])
    out, copied, depth, start, found = [], 0, 0, 0, False
    for begin, end, kind in tags:
        if depth == 0 and kind == 1:
            start, depth = begin, 1
        elif depth:
            depth += kind
            if depth == 0:
                out += [text[copied:start], "[redacted]"]
                copied, found = end, True
    return "".join(out) + text[copied:], found


def redacted(x: Column) -> Column:
    """Column form of :func:`redact_private`; only texts with a tag go through Python."""
    run = F.pandas_udf(lambda s: s.map(lambda t: redact_private(t)[0]), "string", F.PandasUDFType.SCALAR)
    return F.when(F.contains(F.lower(x), F.lit("<private")), run(x)).otherwise(x)


def tolerant_json(text: str | None) -> list[dict]:
    """Objects of a model's reply: parsed as is, else unfenced, else repaired, else each object that can be saved."""
    if not text:
        return []
    body = re.sub(r"^\s*```[a-zA-Z]*\s*|\s*```\s*$", "", text.strip())
    candidates = [text, body]
    if "{" in body:
        candidates.append(body[body.index("{") : body.rfind("}") + 1])
    if "[" in body:
        candidates.append(body[body.index("[") : body.rfind("]") + 1])
    candidates += [re.sub(r",\s*([\]}])", r"\1", c) for c in candidates[1:]]
    for c in candidates:
        try:
            value = json.loads(c, strict=False)  # line ends inside strings are let pass
        except ValueError:
            continue
        rows = value if isinstance(value, list) else next((v for v in value.values() if isinstance(v, list)), [value]) if isinstance(value, dict) else []
        return [r for r in rows if isinstance(r, dict)]
    saved, decoder, at = [], json.JSONDecoder(strict=False), 0
    while (at := body.find("{", at)) >= 0:
        try:
            value, end = decoder.raw_decode(body, at)
            if isinstance(value, dict):
                saved.append(value)
            at = end
        except ValueError:
            at += 1
    return saved


def age_days(then: Column, now: Column) -> Column:
    """Whole days from ``then`` to ``now``, never negative."""
    return F.greatest(F.lit(0), F.floor((F.unix_timestamp(now) - F.unix_timestamp(then)) / 86400)).cast("long")


def fraction_days(then: Column, now: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(then)) / F.lit(8.64e10)
