"""Functions on maps, arrays and dynamic (VARIANT) records."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanfield.functions.binding import let


def map_values(m: Column, fn) -> Column:
    """apply `fn` to every value."""
    return F.transform_values(m, lambda _, v: fn(v))


def truthy(value: Column, kind: str) -> Column:
    """Python truth of a `string`, `number`, `boolean` or `array` value."""
    test = {
        "string": lambda: value != "",
        "number": lambda: value != 0,
        "boolean": lambda: value,
        "array": lambda: F.size(value) > 0,
    }[kind]()
    return F.coalesce(test, F.lit(False))


def afilter(a: Column, fn=None, kind: str = "string") -> Column:
    """keep elements where `fn` holds; without `fn` the truthy ones of `kind`."""
    return F.filter(a, fn or (lambda x: truthy(x, kind)))


def _together(arrays, body) -> Column:
    """`body` of the arrays, each cut to the shortest."""

    def cut(boxed):
        each = [boxed[f"a{n}"] for n in range(len(arrays))]
        shortest = F.least(*[F.size(a) for a in each])
        return body(*[F.slice(a, F.lit(1), shortest) for a in each])

    return let(F.struct(*[a.alias(f"a{n}") for n, a in enumerate(arrays)]), cut)


def zip_positional(a: Column, b: Column, names=("first", "second")) -> Column:
    """Pair elements by position, cut to the shorter array."""
    pair = lambda x, y: F.struct(x.alias(names[0]), y.alias(names[1]))
    return _together([a, b], lambda a, b: F.zip_with(a, b, pair))


def amap(fn, *arrays: Column) -> Column:
    """map over one or more arrays, cut to the shortest."""
    if len(arrays) == 1:
        return F.transform(arrays[0], fn)
    names = [f"a{n}" for n in range(len(arrays))]
    return _together(
        arrays,
        lambda *cut: F.transform(
            F.arrays_zip(*[c.alias(n) for c, n in zip(cut, names)]),
            lambda row: fn(*[row[n] for n in names]),
        ),
    )


def to_str_array(a: Column) -> Column:
    """F8."""
    return a.cast("array<string>")


def to_int_array(a: Column) -> Column:
    """F8: an element that is no whole number gives NULL."""
    return F.transform(a, lambda x: x.try_cast("bigint"))


def flatten(a: Column) -> Column:
    """one level."""
    return F.flatten(a)


def chunk_array(a: Column, n: int, fill: Column) -> Column:
    """F5 for arrays: chunks of `n`, the last one padded with `fill`."""

    def chunked(a):
        def chunk(i):
            part = F.slice(a, i * n + 1, F.lit(n))
            return F.concat(part, F.array_repeat(fill, n - F.size(part)))

        count = F.ceil(F.size(a) / n).cast("int")
        return F.when(F.size(a) > 0, F.transform(F.sequence(F.lit(0), count - 1), chunk)).when(
            F.size(a) == 0, F.array_repeat(a, 0)
        )

    return let(a, chunked)


def first_link_with_prefix(links: Column, prefix: str) -> Column:
    """L8."""
    return F.get(F.filter(links, lambda x: F.startswith(x, F.lit(prefix))), F.lit(0))


def dol_pairs(m: Column) -> Column:
    """F11 within a record: map of arrays to `ARRAY<STRUCT<k, v>>`; a NULL value is one pair."""
    return F.flatten(
        F.transform(
            F.map_entries(m),
            lambda e: F.transform(
                F.coalesce(e["value"], F.array_repeat(F.get(e["value"], F.lit(0)), 1)),
                lambda v: F.struct(e["key"].alias("k"), v.alias("v")),
            ),
        )
    )


def pairs_dol(pairs: Column) -> Column:
    """F12 within a record: `ARRAY<STRUCT<k, v>>` to map of arrays, keys in first-seen order."""

    def grouped(pairs):
        keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
        values = lambda k: F.transform(
            F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"]
        )
        entries = F.transform(keys, lambda k: F.struct(k.alias("key"), values(k).alias("value")))
        return F.map_from_entries(entries)

    return let(pairs, grouped)


def _kind(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _as_map(v: Column) -> Column:
    return v.try_cast("map<string,variant>")


def _as_list(v: Column) -> Column:
    return v.try_cast("array<variant>")


def _overlay(a: Column, b: Column, merge) -> Column:
    """Entries of `a` then those only in `b`; shared keys get `merge(old, new)`."""

    def overlaid(boxed):
        a, b = boxed["a"], boxed["b"]
        kept = F.transform(
            F.map_entries(a),
            lambda e: F.struct(
                e["key"],
                F.when(F.map_contains_key(b, e["key"]), merge(e["value"], b[e["key"]]))
                .otherwise(e["value"])
                .alias("value"),
            ),
        )
        added = F.filter(F.map_entries(b), lambda e: ~F.map_contains_key(a, e["key"]))
        return F.map_from_entries(F.concat(kept, added))

    return let(F.struct(a.alias("a"), b.alias("b")), overlaid)


def soft_update(
    records: list[Column], dict_mode: str = "override", list_mode: str = "override"
) -> Column:
    """merge `MAP<STRING, VARIANT>` records from left to right.

    Presence of a key decides, so an explicit null replaces a value. Nested
    objects follow `dict_mode` (`override`, `update`), arrays `list_mode`
    (`override`, `append`, `set`); all else, and any change of type, replaces.
    """
    if dict_mode not in ("override", "update"):
        raise ValueError(f"unknown dict mode {dict_mode!r}")
    if list_mode not in ("override", "append", "set"):
        raise ValueError(f"unknown list mode {list_mode!r}")

    def merge(old, new):
        result = F
        if dict_mode == "update":
            result = result.when(
                (_kind(old) == "OBJECT") & (_kind(new) == "OBJECT"),
                F.to_variant_object(_overlay(_as_map(old), _as_map(new), lambda _, n: n)),
            )
        if list_mode != "override":
            have, more = _as_list(old), _as_list(new)
            joined = F.concat(have, more)
            if list_mode == "set":
                unseen = lambda seen: F.filter(
                    more, lambda x: ~F.array_contains(seen, F.to_json(x))
                )
                joined = F.concat(have, let(F.transform(have, lambda x: F.to_json(x)), unseen))
            result = result.when(
                (_kind(old) == "ARRAY") & (_kind(new) == "ARRAY"), F.to_variant_object(joined)
            )
        return new if result is F else result.otherwise(new)

    merged = records[0]
    for record in records[1:]:
        merged = _overlay(merged, record, merge)
    return merged
