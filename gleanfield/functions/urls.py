"""URL functions, evaluated wholly in the JVM."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanfield.functions.binding import let

# Schemes whose last path segment may carry `;params`, and schemes
# written with `//` even when the authority is empty (Python's urllib.parse).
PARAM_SCHEMES = (
    " ftp hdl prospero http https shttp rtsp rtsps sip sips mms sftp tel".split(" ")
)
AUTHORITY_SCHEMES = (
    "ftp http gopher nntp telnet imap wais file mms https shttp snews prospero rtsp rtsps "
    "rsync svn svn+ssh sftp nfs git git+ssh ws wss itms-services"
).split()

_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_IS_URL = (
    r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#\[\]]+(?=[/?#]|$)|(?=[^/?#]*\[)(?=[^/?#]*\]))"
)
_CUT = r"(?s)^([^:]*)(:[^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_EMPTY_PARAMS = r"(?s)^(://[^/]+/(?:.*/)?[^/;]*);$"
_LAST_SEGMENT = r"(?s)^((?:.*/)?[^/;]*)(?:;([^/]*))?$"
_LEADING = "".join(map(chr, range(0x21)))


def _tail(mark: str, text: Column) -> Column:
    return F.when(text != "", F.concat(F.lit(mark), text)).otherwise("")


def _clean(url: Column) -> Column:
    return F.ltrim(F.translate(url, "\t\r\n", ""), F.lit(_LEADING))


def _decode(text: Column) -> Column:
    """Percent-decode; a stray `%` stands for itself and `+` for a blank."""
    return F.url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(text: Column) -> Column:
    """Form-encode, with `~` left as it is and `*` escaped."""
    return F.replace(
        F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A")
    )


def _query_pairs(query: Column) -> Column:
    """Ordered `k=v` pairs: blank values dropped, first value per key kept."""
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p.rlike("(?s)^[^=]*=.")),
        lambda p: F.struct(
            _decode(F.split_part(p, F.lit("="), F.lit(1))).alias("k"),
            _decode(F.regexp_replace(p, "(?s)^[^=]*=", "")).alias("v"),
        ),
    )
    return let(
        pairs,
        lambda all_: F.filter(
            all_,
            lambda x, i: F.array_position(F.transform(all_, lambda y: y["k"]), x["k"]) == i + 1,
        ),
    )


def _query_text(pairs: Column) -> Column:
    return F.array_join(
        F.transform(pairs, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&"
    )


def unpack_url(url: Column) -> Column:
    """`STRUCT<scheme, netloc, path, params, query ARRAY<STRUCT<k, v>>, fragment>`."""

    def struct(parts):
        part = lambda n: F.get(parts, F.lit(n))
        scheme, path = F.lower(part(0)), part(2)
        has_params = scheme.isin(PARAM_SCHEMES) & path.contains(";")
        segment = lambda n, other: F.when(
            has_params, F.regexp_extract(path, _LAST_SEGMENT, n)
        ).otherwise(other)
        return F.struct(
            scheme.alias("scheme"),
            part(1).alias("netloc"),
            segment(1, path).alias("path"),
            segment(2, "").alias("params"),
            _query_pairs(part(3)).alias("query"),
            part(4).alias("fragment"),
        )

    cut = F.regexp_replace(_clean(url), _URL, "$1\x01$2\x01$3\x01$4\x01$5")
    return let(F.split(cut, "\x01"), lambda parts: F.when(parts.isNotNull(), struct(parts)))


def pack_url(parts: Column) -> Column:
    """Inverse of `unpack_url`; the query is re-encoded in its own order."""
    path = F.concat(parts["path"], _tail(";", parts["params"]))
    authority = (
        F.when(
            parts["netloc"] != "",
            F.concat(
                F.lit("//"),
                parts["netloc"],
                F.when((path != "") & ~path.startswith("/"), "/").otherwise(""),
            ),
        )
        .when(path.startswith("//"), "//")
        .when(
            parts["scheme"].isin(AUTHORITY_SCHEMES) & ((path == "") | path.startswith("/")), "//"
        )
        .otherwise("")
    )
    scheme = F.when(parts["scheme"] != "", F.concat(parts["scheme"], F.lit(":"))).otherwise("")
    return F.concat(
        scheme, authority, path,
        _tail("?", _query_text(parts["query"])), _tail("#", parts["fragment"]),
    )


def is_url(text: Column) -> Column:
    """Scheme and authority both present, brackets of the authority paired."""
    return text.contains("://") & _clean(text).rlike(_IS_URL)


_CLEANED = "trim(LEADING '{leading}' FROM translate({c}, '\\t\\r\\n', ''))"
# What cleaning leaves as it is: nothing to decode, no `;`, and a query of at most one key, which is kept.
_CLEAN_ALREADY = r"^[a-z][a-z0-9]*+://[A-Za-z0-9.\-]++(?:/[A-Za-z0-9._\-/]*+)?(?:\?(?!{prefix})[A-Za-z0-9._\-]++=[A-Za-z0-9._\-]++)?\z"
_CLEAN_URL = """
CASE WHEN NOT contains({c}, '://') OR {c} RLIKE r'{clean_already}' THEN {c}
WHEN {cleaned} RLIKE r'{is_url}' THEN
  transform(
    array(split(regexp_replace({cleaned}, r'{cut}', '$1\\u0001$2\\u0001$3\\u0001$4'), '\\u0001')),
    part -> concat(
      lower(part[0]),
      regexp_replace(part[1], r'{empty_params}', '$1'),
      transform(
        array(array_join(
          transform(
            array(transform(
              filter(split(part[2], '&'), p -> p RLIKE '(?s)^[^=]*=.'),
              p -> transform(
                array(split_part(p, '=', 1), regexp_replace(p, '(?s)^[^=]*=', '')),
                t -> url_decode(regexp_replace(t, '%(?![0-9A-Fa-f]{{2}})', '%25'))))),
            kvs -> array_join(
              transform(
                filter(kvs, (kv, i) ->
                  array_position(transform(kvs, o -> o[0]), kv[0]) = i + 1
                  AND NOT startswith(kv[0], '{prefix}')),
                kv -> array_join(
                  transform(kv, t -> replace(replace(url_encode(t), '%7E', '~'), '*', '%2A')),
                  '=')),
              '&')),
          '')),
        query -> if(query = '', '', concat('?', query)))[0],
      if(part[3] = '', '', concat('#', part[3]))))[0]
ELSE {c} END
"""


def clean_url(column: str, prefix: str = "utm") -> Column:
    """N6 for one column: drop query keys starting with `prefix`; other text unchanged.

    Gives what unpacking, dropping the keys and packing again gives. It is one SQL
    expression because it is applied to every text column of a record.
    """
    c = "`" + column.replace("`", "``") + "`"
    leading = "".join(f"\\u{code:04x}" for code in range(0x21))
    return F.expr(
        _CLEAN_URL.format(
            c=c, cleaned=_CLEANED.format(c=c, leading=leading), is_url=_IS_URL, cut=_CUT,
            empty_params=_EMPTY_PARAMS, prefix=prefix,
            clean_already=_CLEAN_ALREADY.format(prefix=re.escape(prefix)),
        )
    )


def absolutise(base: Column | str, path: Column) -> Column:
    """L3: plain concatenation; a NULL path stays NULL."""
    return F.concat(F.lit(base) if isinstance(base, str) else base, path)


def mailto_address(href: Column) -> Column:
    """Percent-decode (`+` stays `+`), keep the text after the last `:`."""
    return F.element_at(F.split(_decode(F.replace(href, F.lit("+"), F.lit("%2B"))), ":"), -1)
