"""URL parse / resolve / normalise and link extraction, as native column expressions.

Semantics follow RFC 3986 reference resolution as done by common URL libraries:
  * parse: scheme (lower-cased), optional //authority, path, ?query, #fragment; an URL
    with control bytes, a bad %-escape in path or fragment, a leading ':', a bad port or
    a colon in the first segment of a relative path is unparseable (null);
  * resolve: absolute refs keep their own parts; //host refs take the base scheme;
    ?query / #fragment / empty refs keep the base path (an empty ref keeps the base query
    and fragment); relative paths merge with the base directory; dot segments removed;
  * output: a path (or fragment) that is not validly encoded is re-escaped with
    upper-case hex (non-ASCII bytes, spaces, ...), otherwise kept as written; the query
    is kept raw;
  * normalise: lower-case scheme and host, nothing else (fragment, query, default port,
    trailing slash and user info are kept).
The <base> element is not honoured. Non-ASCII host names are kept as written.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions.expr import let as _let
from trawl.functions.html import A_TAGS, decode_entities

_URL_RE = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"
_BAD_ESCAPE = r"%(?![0-9A-Fa-f]{2})"
_CTL = r"[\x00-\x1f\x7f]"
# Characters allowed unescaped in a path / fragment "as written" (valid encoding check).
_PATH_VALID = r"^[A-Za-z0-9\-_.~!$&'()*+,;=:@\[\]%/]*$"
_FRAG_VALID = r"^[A-Za-z0-9\-_.~!$&'()*+,;=:@\[\]%/?]*$"
# Characters kept literally when a path / fragment is re-escaped.
_PATH_KEEP = r"[A-Za-z0-9\-_.~$&+,/:;=@]"
_FRAG_KEEP = r"[A-Za-z0-9\-_.~$&+,/:;=?@!()*]"
_HOST_OK = r"^[A-Za-z0-9\-_.~!$&'()*+,;=:\[\]<>\"%\x{80}-\x{10FFFF}]*$"
# An attribute: its name and, if it has one, its value (quoted or not).
_ATTRIBUTE = r"""(?s)([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>"'][^\s>]*+)?)?"""
_BIG = 1 << 30


def _re_escape(s: Column, keep_re: str) -> Column:
    """Escape every character not in keep_re; %XX escapes are normalised."""
    def one(tok: Column) -> Column:
        is_pct = F.startswith(tok, F.lit("%")) & (F.length(tok) == 3)
        dec = F.decode(F.unhex(F.substring(tok, 2, 2)), "ISO-8859-1")
        return (F.when(is_pct & dec.rlike(keep_re), dec)
                .when(is_pct, F.upper(tok))
                .when(tok.rlike(keep_re), tok)
                .otherwise(F.regexp_replace(F.hex(F.encode(tok, "UTF-8")), "(..)", "%$1")))
    toks = F.regexp_extract_all(s, F.lit(r"(?s)%[0-9A-Fa-f]{2}|."), 0)
    return F.array_join(F.transform(toks, one), "")


def escaped_path(p: Column) -> Column:
    return F.when(p.rlike(_PATH_VALID), p).otherwise(_re_escape(p, _PATH_KEEP))


def escaped_fragment(f: Column) -> Column:
    return F.when(f.rlike(_FRAG_VALID), f).otherwise(_re_escape(f, _FRAG_KEEP))


def parse_url(c: Column) -> Column:
    """struct(ok, scheme, auth, userinfo, host, path, query, frag, opaque).

    auth: whether an authority was given; query / frag keep their delimiter ('?x',
    '#x'; '' when absent, '?' alone for an empty query).
    """
    return _let(c, _parse)


def _parse(c: Column) -> Column:
    groups = F.struct(*[F.regexp_extract(c, _URL_RE, i).alias(f"g{i}") for i in range(6)],
                      F.coalesce(c, F.lit("")).alias("src"), c.isNotNull().alias("present"))
    return _let(groups, _parse_parts)


def _parse_parts(g: Column) -> Column:
    scheme, auth_raw, path_raw = F.lower(g["g1"]), g["g2"], g["g3"]
    # Without a scheme "///x" is a path, not an empty authority.
    triple = (scheme == "") & F.startswith(g["src"], F.lit("///"))
    auth = (auth_raw != "") & ~triple
    path = F.when(triple, F.concat(auth_raw, path_raw)).otherwise(path_raw)
    authority = F.substring(auth_raw, 3, _BIG)
    at = F.length(authority) - F.instr(F.reverse(authority), "@")  # index of the last '@'
    has_user = F.instr(authority, "@") > 0
    parts = F.struct(
        scheme.alias("scheme"), auth.alias("auth"),
        F.when(has_user, F.left(authority, at)).otherwise(F.lit(None).cast("string")).alias("userinfo"),
        F.when(has_user, F.substring(authority, at + 2, _BIG)).otherwise(authority).alias("host"),
        path.alias("path"), g["g4"].alias("query"), g["g5"].alias("frag"),
        ((scheme != "") & ~auth & ~F.startswith(path, F.lit("/"))).alias("opaque"),
        (g["present"] & (g["g0"] == g["src"]) & ~g["src"].rlike(_CTL)
         & ~F.startswith(g["src"], F.lit(":"))).alias("ok0"),
    )
    return _let(parts, _validate)


def _validate(u: Column) -> Column:
    port = F.regexp_extract(u["host"], r":([^:\]]*)$", 1)
    ok = (u["ok0"] & ~u["path"].rlike(_BAD_ESCAPE) & ~F.substring(u["frag"], 2, _BIG).rlike(_BAD_ESCAPE)
          & ~((u["scheme"] == "") & ~u["auth"] & u["path"].rlike(r"^[^/]*:"))
          & (~u["auth"] | (u["host"].rlike(_HOST_OK) & ~u["host"].rlike(_BAD_ESCAPE) & port.rlike(r"^[0-9]*$"))))
    return F.struct(ok.alias("ok"), *[u[k].alias(k) for k in
                                      ("scheme", "auth", "userinfo", "host", "path", "query", "frag", "opaque")])


def remove_dot_segments(full: Column) -> Column:
    """RFC 3986 section 5.2.4 on whole segments; the result starts with "/" (empty stays empty).

    Segments are pushed on a list: "." pushes nothing, ".." takes the last one off, and
    either of them at the end leaves a trailing slash. Where ".." climbs past the root, an
    empty segment right after it is dropped too, as the reference's URL library does.
    """
    def push(rooted: Column):
        def step(acc: Column, seg: Column) -> Column:
            n = F.size(acc["out"])
            past = (n == 0) | ((n == 1) & ~rooted)
            out = (F.when((seg == ".") | ((seg == "") & acc["past"]), acc["out"])
                   .when(seg == "..", F.slice(acc["out"], F.lit(1), F.greatest(n - 1, F.lit(0))))
                   .otherwise(F.concat(acc["out"], F.array(seg))))
            return F.struct(out.alias("out"), F.when(seg == "..", past | acc["past"]).otherwise(F.lit(False)).alias("past"))
        return step

    def join(segments: Column) -> Column:
        last = F.element_at(segments, -1)
        # A leading "/" opens an empty first segment, which is the root and not part of the path.
        rooted = F.get(segments, 0) == ""
        inner = F.when(rooted, F.slice(segments, F.lit(2), F.size(segments))).otherwise(segments)
        init = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("past"))
        body = F.concat(F.lit("/"), F.array_join(F.aggregate(inner, init, push(rooted), lambda a: a["out"]), "/"))
        return F.when(last.isin(".", "..") & ~F.endswith(body, F.lit("/")), F.concat(body, F.lit("/"))).otherwise(body)

    return F.when(full == "", F.lit("")).otherwise(_let(F.split(full, "/"), join))


def _merge(p: Column) -> Column:
    base_path, ref_path = p["bp"], p["rp"]
    ri = F.instr(F.reverse(base_path), "/")
    base_dir = F.when(ri == 0, F.lit("")).otherwise(F.left(base_path, F.length(base_path) - ri + 1))
    full = (F.when(ref_path == "", base_path)
            .when(~F.startswith(ref_path, F.lit("/")), F.concat(base_dir, ref_path))
            .otherwise(ref_path))
    return remove_dot_segments(full)


def resolve(base: Column, ref: Column) -> Column:
    """Resolve a parsed reference against a parsed base (both from `parse_url`)."""
    return _let(F.struct(base.alias("b"), ref.alias("r")), lambda x: _resolve(x["b"], x["r"]))


def _resolve(base: Column, ref: Column) -> Column:
    ref_abs = (ref["scheme"] != "") | (ref["auth"] & (ref["host"] != "")) | ref["userinfo"].isNotNull()
    bare = (ref["path"] == "") & (ref["query"] == "")
    merged = _let(F.struct(escaped_path(base["path"]).alias("bp"), escaped_path(ref["path"]).alias("rp")), _merge)
    path = (F.when(ref["opaque"], ref["path"])
            .when(ref_abs, remove_dot_segments(escaped_path(ref["path"])))
            .otherwise(merged))
    return F.struct(
        (base["ok"] & ref["ok"]).alias("ok"),
        F.when(ref["scheme"] != "", ref["scheme"]).otherwise(base["scheme"]).alias("scheme"),
        F.when(ref_abs, ref["auth"]).otherwise(base["auth"]).alias("auth"),
        F.when(ref_abs, ref["userinfo"]).otherwise(base["userinfo"]).alias("userinfo"),
        F.when(ref_abs, ref["host"]).otherwise(base["host"]).alias("host"),
        path.alias("path"),
        F.when(~ref_abs & bare, base["query"]).otherwise(ref["query"]).alias("query"),
        F.when(~ref_abs & bare & (ref["frag"] == ""), base["frag"]).otherwise(ref["frag"]).alias("frag"),
        ref["opaque"].alias("opaque"),
    )


def url_string(u: Column) -> Column:
    """Format a parsed URL with scheme and host lower-cased (the normal form)."""
    parts = F.struct(u.alias("u"), F.lower(u["host"]).alias("host"),
                     F.when(u["opaque"], u["path"]).otherwise(escaped_path(u["path"])).alias("path"))
    return _let(parts, _format)


def _format(x: Column) -> Column:
    u, host, path = x["u"], x["host"], x["path"]
    has_user = u["userinfo"].isNotNull()
    show_slashes = ~u["opaque"] & u["auth"] & ((host != "") | (path != "") | has_user)
    auth = F.when(show_slashes, F.concat(
        F.lit("//"), F.when(has_user, F.concat(u["userinfo"], F.lit("@"))).otherwise(F.lit("")),
        host)).otherwise(F.lit(""))
    sep = F.when(~u["opaque"] & (path != "") & ~F.startswith(path, F.lit("/")) & (host != ""),
                 F.lit("/")).otherwise(F.lit(""))
    frag = F.substring(u["frag"], 2, _BIG)
    return F.concat(
        F.when(u["scheme"] != "", F.concat(u["scheme"], F.lit(":"))).otherwise(F.lit("")),
        auth, sep, path, u["query"],
        F.when(frag != "", F.concat(F.lit("#"), escaped_fragment(frag))).otherwise(F.lit("")))


def normalize_url(c: Column) -> Column:
    """Lower-case scheme and host; null when the URL cannot be parsed."""
    return _let(parse_url(c), lambda u: F.when(u["ok"], url_string(u)))


def is_valid_url(c: Column) -> Column:
    """Parseable and scheme http or https (mailto:, javascript:, ftp: are not)."""
    return _let(parse_url(c), lambda u: F.coalesce(u["ok"] & u["scheme"].isin("http", "https"), F.lit(False)))


def _http_string(r: Column) -> Column:
    return F.when(r["ok"] & r["scheme"].isin("http", "https"), url_string(r))


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve href against base, keep http(s) only, normalise; else null."""
    return _let(resolve(parse_url(base), parse_url(href)), _http_string)


def domain_key(url: Column) -> Column:
    """Robots key: scheme://host[:port] in lower case (user info dropped); null if unparseable."""
    return _let(parse_url(url), lambda u: F.when(
        u["ok"] & u["auth"], F.concat(u["scheme"], F.lit("://"), F.lower(u["host"]))))


def _href_of(attributes: Column) -> Column:
    """Value of the first attribute named href (null if there is none), unquoted and decoded."""
    names = F.transform(F.regexp_extract_all(attributes, F.lit(_ATTRIBUTE), 1), F.lower)
    values = F.regexp_extract_all(attributes, F.lit(_ATTRIBUTE), 2)
    at = F.array_position(names, "href").cast("int")
    return _let(F.when(at > 0, F.get(values, at - 1)), lambda v: decode_entities(
        F.when(v.rlike(r"""(?s)^(".*"|'.*')$"""), F.substring(v, 2, F.length(v) - 2)).otherwise(v), attribute=True))


def raw_hrefs(html: Column) -> Column:
    """First href value of every <a> tag that has one, unquoted and entity-decoded, in document order."""
    tags = F.filter(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(A_TAGS), 2), lambda t: t != "")
    return F.filter(F.transform(tags, _href_of), lambda v: v.isNotNull())


def extract_links(html: Column, page_url: Column) -> Column:
    """Distinct resolved, valid, normalised <a href> targets in document order.

    The first href of each <a> tag counts; comments and script/style/noscript raw text
    hold no links; attribute values are entity-decoded before resolution.
    """
    vals = raw_hrefs(html)
    return _let(parse_url(page_url), lambda base: F.array_distinct(F.filter(
        F.transform(vals, lambda h: _let(resolve(base, parse_url(h)), _http_string)),
        lambda x: x.isNotNull())))
