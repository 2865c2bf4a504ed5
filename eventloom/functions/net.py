"""IP addresses, hosts, DSNs and endpoints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind, strip_blanks

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_GROUPS = r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*"


def is_ipv4(col: Column) -> Column:
    return col.rlike(rf"\A{_IPV4}\z")


def _ipv6_hex(col: Column) -> Column:
    """An embedded IPv4 tail fills the last two of eight groups."""
    return F.regexp_replace(col, rf"(?<=:){_IPV4}\z", "0:0")


def _groups(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))


def _ipv6_sides(text: Column) -> tuple[Column, Column]:
    return (_groups(F.substring_index(text, "::", 1)),
            F.when(F.contains(text, F.lit("::")), _groups(F.substring_index(text, "::", -1)))
            .otherwise(F.array().cast("array<string>")))


def _is_ipv6_text(text: Column) -> Column:
    left, right = _ipv6_sides(text)
    count = F.size(left) + F.size(right)
    shaped = text.rlike(rf"\A(?:{_GROUPS})?(?:::(?:{_GROUPS})?)?\z")
    fits = F.when(F.contains(text, F.lit("::")), count <= 7).otherwise(count == 8)
    return F.contains(text, F.lit(":")) & shaped & fits


def is_ipv6(col: Column) -> Column:
    return bind(_ipv6_hex(col), _is_ipv6_text)


def is_ip(col: Column) -> Column:
    return is_ipv4(col) | is_ipv6(col)


def _ipv6_prefix(text: Column) -> Column:
    """The first 48 bits in canonical text."""
    left, right = _ipv6_sides(text)
    gap = F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.size(left) - F.size(right)))
    head = F.transform(
        F.slice(F.concat(left, gap, right), 1, 3),
        lambda g: F.regexp_replace(F.lower(g), r"\A0+(?=.)", ""))
    prefix = F.regexp_replace(
        F.concat(F.array_join(head, ":"), F.lit(":")), r"(?<![^:])(?:0:)+\z", "")
    return F.concat(F.when(prefix == "", ":").otherwise(prefix), F.lit(":"))


def anonymize_ip(col: Column) -> Column:
    """IPv4 with a zero last octet, IPv6 cut to 48 bits in canonical text, else null."""
    def masked(ip: Column) -> Column:
        v6 = bind(_ipv6_hex(ip), lambda t: F.when(_is_ipv6_text(t), _ipv6_prefix(t)))
        return (F.when(F.contains(ip, F.lit(":")), v6)
                .when(is_ipv4(ip), F.concat(F.substring_index(ip, ".", 3), F.lit(".0"))))

    return bind(col, masked)


def client_ip(forwarded: Column, real: Column, remote: Column) -> Column:
    """First forwarded hop, else the proxy's header, else the peer; '' counts as missing."""
    hop = strip_blanks(F.substring_index(forwarded, ",", 1))
    return F.coalesce(*[F.when(c != "", c) for c in (hop, real, remote)])


def _host_port(rest: Column) -> Column:
    """The host[:port] part of text that starts with an authority."""
    return F.substring_index(F.regexp_extract(rest, r"\A[^/?#]*", 0), "@", -1)


def _port_text(host_port: Column) -> Column:
    return F.when(host_port.rlike(r"\A\[[^\n]*\]\z"), "").otherwise(
        F.regexp_extract(host_port, r":([^:]*)\z", 1))


def _port_number(port: Column) -> Column:
    """The leading number of a port, null when it has none."""
    digits = F.regexp_extract(port, r"\A\s*\+?([0-9]{1,9})", 1)
    return F.when(digits != "", digits).cast("int")


def _host(host_port: Column) -> Column:
    return F.when(host_port.rlike(r"\A\[[^\n]*\]\z"), host_port).otherwise(
        F.regexp_replace(host_port, r":[^:]*\z", ""))


def _bad_host_port(host_port: Column) -> Column:
    port = _port_text(host_port)
    bad_port = (port != "") & (
        (F.octet_length(port) > 5) | F.coalesce(_port_number(port) > 65535, F.lit(True)))
    return (_host(host_port) == "") | bad_port


def url_is_malformed(col: Column) -> Column:
    """Whether a lenient URL reader gives up: no host after '//', or an impossible port.

    Besides absolute and '//' URLs it covers the scheme-less 'name:port' forms.
    """
    after_scheme = F.regexp_extract(col, r"(?s)\A[A-Za-z0-9+.\-]+://(.*)", 1)
    after_slashes = F.substring(col, F.lit(3), F.length(col))
    early_port = F.regexp_extract(col, r"\A[^:?#]*:([0-9]{1,5})(?:/|\z)", 1).try_cast("int") > 65535
    is_file = col.rlike(r"\A(?i:file):///")
    named_port = col.rlike(r"\A[A-Za-z0-9+.\-]+:[0-9]{1,5}(?:/|\z)")
    odd_port = col.rlike(r"\A[^:?#]*[^A-Za-z0-9+.\-:?#][^:?#]*:[0-9]{1,5}(?:/|\z)")
    colon_first = col.rlike(r"\A:(?:[0-9]{1,5}(?:/|\z)|\z)")
    slashes = F.startswith(col, F.lit("//"))
    safe_early = F.when(named_port | odd_port, early_port).otherwise(F.lit(False))
    return (
        F.when(is_file, F.lit(False))
        .when(col.rlike(r"\A[A-Za-z0-9+.\-]+://"), _bad_host_port(_host_port(after_scheme)))
        .when(colon_first | safe_early, F.lit(True))
        .when(slashes, _bad_host_port(_host_port(after_slashes)))
        .when(odd_port, _host(_host_port(col)) == "")
        .otherwise(F.lit(False))
    )


def dsn_parts(col: Column) -> Column:
    """A DSN as a struct (raw, scheme, host, port, project_id), null when it is not acceptable."""
    raw = strip_blanks(col)
    shape = r"(?s)\A((?i:https?))://([^/?#]*)/+([^/?#]+)(?:[?#].*)?\z"
    authority = F.regexp_extract(raw, shape, 2)
    usable = (raw.rlike(shape) & ~F.contains(authority, F.lit("@")) & ~_bad_host_port(authority))
    return F.when(usable, F.struct(
        raw.alias("raw"),
        F.regexp_extract(raw, shape, 1).alias("scheme"),
        _host(authority).alias("host"),
        _port_number(_port_text(authority)).alias("port"),
        F.regexp_extract(raw, shape, 3).alias("project_id"),
    ))


def _with_port(host: Column, port: Column) -> Column:
    return F.when(port.isNull(), host).otherwise(F.concat(host, F.lit(":"), port.cast("string")))


def ingest_url(dsn: Column, path: str) -> Column:
    return F.when(dsn.isNotNull(), F.concat(
        dsn["scheme"], F.lit("://"), _with_port(dsn["host"], dsn["port"]),
        F.lit("/" + path.lstrip("/"))))


def dsn_label(dsn: Column) -> Column:
    return F.when(dsn.isNotNull(), F.concat(
        F.lit("[dsn "), dsn["host"], F.lit("/"), dsn["project_id"], F.lit("]")))


def log_endpoint(col: Column) -> Column:
    """scheme://host[:port] of a log endpoint, null unless it is a readable http(s) URL."""
    shape = r"(?s)\A(https?)://([^/?#]*)(?:[/?#].*)?\z"
    host_port = _host_port(F.regexp_extract(col, shape, 2))
    usable = col.rlike(shape) & ~_bad_host_port(host_port)
    return F.when(usable, F.concat(
        F.regexp_extract(col, shape, 1), F.lit("://"),
        _with_port(_host(host_port), _port_number(_port_text(host_port)))))
