"""URL split (R1) and normalisation (R2) as column expressions.

Behaviour of the HTTP client's URL parser, re-expressed with Spark's
regular expressions and higher-order array functions (no Python): the
RFC 3986 split, lower-cased scheme and host, empty port dropped, and for
http/https (or no scheme) dot segments removed and characters outside the
allowed sets percent-encoded, existing escapes upper-cased.  Hosts are
lower-cased as ASCII; IDNA encoding of non-ASCII hosts is not built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: RFC 3986 patterns and character sets -------------------------
SCHEME_START = r"^(?:[a-zA-Z][a-zA-Z0-9+-]*:|/)"
URI = r"(?s)^(([a-zA-Z][a-zA-Z0-9+.-]*):)?(//([^\\/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"
# possessive throughout: a long host must neither recurse nor backtrack
REG_NAME = r"(?:[^\[\]%:/?#]++|%[a-fA-F0-9]{2})*+"
HEX16 = r"[0-9A-Fa-f]{1,4}"
IPV4 = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"


def ipv6_grammar() -> str:
    """IPv6address of RFC 3986: at most one ``::``, eight groups in all, the last two may be an IPv4 address."""
    last = f"(?:{HEX16}:{HEX16}|{IPV4})"
    forms = [f"(?:{HEX16}:){{6}}{last}"]
    for before in range(0, 6):
        # ``before`` groups may stand before "::"; the rest follow it
        left = f"(?:(?:{HEX16}:){{0,{before - 1}}}{HEX16})?" if before > 1 else f"(?:{HEX16})?" if before else ""
        forms.append(f"{left}::(?:{HEX16}:){{{5 - before}}}{last}")
    forms.append(f"(?:(?:{HEX16}:){{0,5}}{HEX16})?::{HEX16}")
    forms.append(f"(?:(?:{HEX16}:){{0,6}}{HEX16})?::")
    return "(?:" + "|".join(forms) + ")"


ZONE_ID = r"(?:%25|%)(?:[A-Za-z0-9._~-]|%[a-fA-F0-9]{2})++"
IPV6_LITERAL = r"\[" + ipv6_grammar() + "(?:" + ZONE_ID + r")?\]"
HOST_PORT = r"(?s)^(" + REG_NAME + "|" + IPV6_LITERAL + r")(?::0*?(|0|[1-9][0-9]{0,4}))?$"
UNRESERVED = "A-Za-z0-9._~"      # and "-", kept last in each class below
SUB_DELIMS = "!$&'()*+,;="
USERINFO_CHARS = "[" + UNRESERVED + SUB_DELIMS + ":-]"
PATH_CHARS = "[" + UNRESERVED + SUB_DELIMS + ":@/-]"
QUERY_CHARS = "[" + UNRESERVED + SUB_DELIMS + ":@/?-]"
ZONE_CHARS = "[" + UNRESERVED + "-]"
NORMALISABLE_SCHEMES = ("http", "https")


def percent_encode(component: Column, allowed: str) -> Column:
    """Upper-case existing ``%xx`` escapes, then escape every character
    outside ``allowed`` as its UTF-8 bytes; a ``%`` stays only if every
    ``%`` in the text starts a valid escape."""
    parts = F.split(component, "%", -1)
    tail = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    valid = lambda x: x.rlike("^[0-9A-Fa-f]{2}")
    upper_tail = F.transform(tail, lambda x: F.when(valid(x), F.concat(F.upper(F.substring(x, 1, 2)),
                                                                          F.substring(x, 3, 1 << 30)))
                             .otherwise(x))
    uppered = F.array_join(F.concat(F.array(parts[0]), upper_tail), "%")
    all_escapes = F.size(F.filter(tail, valid)) == F.size(tail)
    chars = F.split(uppered, "", -1)
    encoded = F.transform(chars, lambda c: F.when(
        c.rlike("^" + allowed + "$") | ((c == "%") & all_escapes), c
    ).otherwise(F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")))
    # most components hold nothing to escape and are never taken apart
    return F.when(component.rlike("^" + allowed + "*+$"), component).when(component.isNotNull(), F.array_join(encoded, ""))


def remove_dot_segments(path: Column) -> Column:
    """RFC 3986 section 5.2.4 over the ``/``-separated segments."""
    segs = F.split(path, "/", -1)
    out = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s != "..", F.array_append(acc, s))
        .when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1))
        .otherwise(acc))
    lead = path.startswith("/") & ((F.size(out) == 0) | (F.get(out, 0) != F.lit("")))
    out = F.when(lead, F.concat(F.array(F.lit("")), out)).otherwise(out)
    trail = path.endswith("/.") | path.endswith("/..")
    out = F.when(trail, F.array_append(out, F.lit(""))).otherwise(out)
    return F.array_join(out, "/")


def parse_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``scheme, auth, host, port, path, query, fragment`` and
    ``parse_error`` (true where the client raises); a null or empty URL
    gives all nulls."""
    u = F.col(url)
    prefixed = F.when(u.rlike(SCHEME_START), u).otherwise(F.concat(F.lit("//"), u))

    def g(i):
        return F.regexp_extract(prefixed, URI, i)

    step = df.select(
        "*",
        F.when(g(1) != "", F.lower(g(2))).alias("_scheme"),
        F.when(g(4) != "", g(4)).alias("_authority"),
        g(5).alias("_path"),
        F.when(g(6) != "", g(7)).alias("_query"),
        F.when(g(8) != "", g(9)).alias("_fragment"),
    )
    scheme, authority = F.col("_scheme"), F.col("_authority")
    normalise = scheme.isNull() | scheme.isin(*NORMALISABLE_SCHEMES)
    host_port = F.substring_index(authority, "@", -1)
    auth_raw = F.when(F.instr(authority, "@") > 0,
                      F.expr("substr(_authority, 1, length(_authority) - length(substring_index(_authority, '@', -1)) - 1)"))
    hp_ok = host_port.rlike(HOST_PORT)
    host_raw = F.regexp_extract(host_port, HOST_PORT, 1)
    port_txt = F.regexp_extract(host_port, HOST_PORT, 2)
    step = step.select(
        *df.columns, "_scheme", "_path", "_query", "_fragment",
        (authority.isNotNull() & ~hp_ok).alias("_bad_host"),
        F.when(authority.isNotNull(), F.when(auth_raw != "", auth_raw)).alias("_auth"),
        F.when(authority.isNotNull() & hp_ok, host_raw).alias("_host"),
        F.when(authority.isNotNull() & hp_ok & (port_txt != ""), port_txt.cast("int")).alias("_port"),
        normalise.alias("_norm"),
    )
    host = F.col("_host")
    # the zone of a scoped address: its separator is unquoted, the rest escaped like any text
    quoted = F.regexp_extract(host, r"%(.*)\]$", 1)
    zone = F.when(quoted.startswith("25") & (quoted != "25"), F.substring(quoted, 3, 1 << 30)).otherwise(quoted)
    lowered = F.when(host.startswith("[") & (F.instr(host, "%") > 0),
                     F.concat(F.lower(F.substring_index(host, "%", 1)), F.lit("%"), percent_encode(zone, ZONE_CHARS), F.lit("]"))) \
        .otherwise(F.lower(host))
    path, query, frag, norm = F.col("_path"), F.col("_query"), F.col("_fragment"), F.col("_norm")
    path_n = F.when(norm & (path != ""), percent_encode(remove_dot_segments(path), PATH_CHARS)).otherwise(path)
    query_n = F.when(norm & (query != ""), percent_encode(query, QUERY_CHARS)).otherwise(query)
    frag_n = F.when(norm & (frag != ""), percent_encode(frag, QUERY_CHARS)).otherwise(frag)
    path_final = F.when(path_n != "", F.when(path_n.startswith("/"), path_n).otherwise(F.concat(F.lit("/"), path_n))) \
        .when(query.isNotNull() | frag.isNotNull(), F.lit(""))
    bad = F.col("_bad_host") | F.coalesce(F.col("_port") > 65535, F.lit(False))
    empty = u.isNull() | (u == "")
    ok = ~bad & ~empty

    def out(c):
        return F.when(ok, c)

    return step.select(
        *df.columns,
        out(F.col("_scheme")).alias("scheme"),
        out(F.when(F.col("_auth").isNotNull() & norm, percent_encode(F.col("_auth"), USERINFO_CHARS))
            .otherwise(F.col("_auth"))).alias("auth"),
        out(F.when(norm & (host != ""), lowered).otherwise(host)).alias("host"),
        out(F.col("_port")).alias("port"),
        out(path_final).alias("path"),
        out(query_n).alias("query"),
        out(frag_n).alias("fragment"),
        (bad & ~empty).alias("parse_error"),
    )


def url_text(scheme: Column, auth: Column, host: Column, port: Column, path: Column,
             query: Column, fragment: Column) -> Column:
    """R2: the parts joined back into text (absent parts left out)."""
    def opt(c, before="", after=""):
        return F.when(c.isNotNull(), F.concat(F.lit(before), c, F.lit(after))).otherwise(F.lit(""))
    return F.concat(opt(scheme, after="://"), opt(auth, after="@"), opt(host),
                    opt(port.cast("string"), before=":"), opt(path), opt(query, before="?"),
                    opt(fragment, before="#"))


def normalise_urls(df: DataFrame, url: str = "url") -> DataFrame:
    parsed = parse_url(df, url)
    text = url_text(*[F.col(c) for c in ("scheme", "auth", "host", "port", "path", "query", "fragment")])
    return parsed.withColumn("normalised_url", F.when(~F.col("parse_error"), text))


def page_urls(pages: DataFrame) -> DataFrame:
    """Every URL of the pages table: the page's own (``link_idx = -1``)
    and each ``href`` link in its HTML, in document order."""
    own = pages.select("page_id", F.lit(-1).cast("bigint").alias("link_idx"), F.col("url"))
    links = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1))
                         .alias("link_idx", "url"))
    return own.unionByName(links.select("page_id", F.col("link_idx").cast("bigint"), "url"))
