"""Jobs, addresses, flags and retries, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import bound

# Hosts that must not be reached, identifiers, versions.
INTERNAL_SUFFIXES = (".localhost", ".local", ".internal", ".corp", ".home", ".arpa", ".onion")
CID = r"^[a-zA-Z0-9]+$"
#: A host whose last label is a number (decimal, octal or hex) is an IPv4 address in one of its spellings, or none at all.
NUMERIC_HOST = r"(?i)(?:^|\.)(?:[0-9]+|0x[0-9a-f]*)\.?$"
STATIC_SCENE_VERSION = "v2004"
TRUE_WORDS, FALSE_WORDS = ("true", "1", "yes", "on"), ("false", "0", "no", "off")
MAX_RETRY_AFTER_MS = 30_000


def url_host(url: Column) -> Column:
    """Lower-case host without port, user or brackets; null if there is none."""
    host = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)
    return F.nullif(F.lower(F.regexp_replace(host, r"[\[\]]", "")), F.lit(""))


def url_scheme(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.\-]*)://", 1)), F.lit(""))


def is_ip(host: Column) -> Column:
    """Whether an address's host is an IP address in any spelling that address parsers take (127.1, 2130706433, 0x7f000001)."""
    return host.rlike(NUMERIC_HOST) | host.contains(":")


def is_safe_url(url: Column) -> Column:
    """https, with a host that is a public name: no IP address, no internal suffix."""

    def public(host: Column) -> Column:
        inside = host == "localhost"
        for s in INTERNAL_SUFFIXES:
            inside = inside | host.endswith(s)
        return (host != "") & ~is_ip(host) & ~inside

    return F.coalesce((url_scheme(url) == "https") & bound(F.regexp_replace(url_host(url), r"\.$", ""), public), F.lit(False))


def allowed_hosts(setting: Column) -> Column:
    """Comma-separated hosts or URLs as a set of lower-case hosts."""
    items = F.transform(F.split(F.coalesce(setting, F.lit("")), ","), lambda x: F.lower(F.trim(x)))
    hosts = F.transform(items, lambda x: F.coalesce(url_host(x), x))
    return F.array_distinct(F.filter(hosts, lambda x: x != ""))


def is_allowed(url: Column, hosts: Column) -> Column:
    return F.coalesce((url_scheme(url) == "https") & F.array_contains(hosts, url_host(url)), F.lit(False))


def reject_reason(entity_id: Column, urls: Column, lods: Column, hosts: Column) -> Column:
    """The first rule that a job breaks; null for a good job."""
    is_lod = F.coalesce(F.size(lods), F.lit(0)) > 0
    return (
        F.when(F.coalesce(entity_id, F.lit("")) == "", "no-entity")
        .when(~entity_id.rlike(CID), "bad-entity-id")
        .when(~is_lod & (F.coalesce(F.get(urls, F.lit(0)), F.lit("")) == ""), "no-url")
        .when(~F.coalesce(F.forall(urls, lambda u: is_allowed(u, hosts)), F.lit(True)), "url-not-allowed")
        .when(is_lod & ~F.forall(lods, is_safe_url), "unsafe-lod-url")
    )


def flag(text: Column, default: bool) -> Column:
    """A boolean setting; unset, '' and unknown words give ``default``."""
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).otherwise(default)


def flag_is_unknown(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.coalesce((text != "") & ~word.isin(*TRUE_WORDS, *FALSE_WORDS), F.lit(False))


def is_retryable(status: Column) -> Column:
    return status.isin(408, 429) | (status >= 500)


def retry_after_ms(text: Column, now: Column) -> Column:
    """Milliseconds of a Retry-After value (seconds, or an HTTP date against ``now``), at most 30 s; null if malformed."""
    t = F.trim(text)
    seconds = F.when(F.char_length(t) > 9, F.lit(MAX_RETRY_AFTER_MS)).otherwise(F.least(t.try_cast("bigint") * 1000, F.lit(MAX_RETRY_AFTER_MS)))
    date = F.try_to_timestamp(F.regexp_replace(t, r"^[A-Za-z]+,\s*", ""), F.lit("dd MMM yyyy HH:mm:ss zzz"))
    wait = F.when(date.isNotNull(), F.least(F.greatest(F.unix_millis(date) - F.unix_millis(now), F.lit(0)), F.lit(MAX_RETRY_AFTER_MS)))
    return F.when(t.rlike(r"^\d+$"), seconds).when(t.rlike("[a-zA-Z]"), wait).cast("bigint")


def backoff_ms(attempt: Column, jitter: Column) -> Column:
    """250 * 2^attempt and up to 250 more; ``jitter`` is in [0, 1)."""
    return (F.pow(F.lit(2), attempt) * 250 + F.floor(jitter * 250)).cast("bigint")


def content_length(text: Column) -> Column:
    return F.coalesce(text.try_cast("bigint"), F.lit(-1))


def fetch_outcome(status: Column, declared: Column, actual: Column, most: int = 256 << 20) -> Column:
    """ok, retryable or fatal, from a response's status and lengths; a body shorter than declared was cut off."""
    return (
        F.when(is_retryable(status), "retryable")
        .when((status < 200) | (status >= 300), "fatal")
        .when((declared > most) | (actual > most), "fatal")
        .when((declared >= 0) & (actual < declared), "retryable")
        .otherwise("ok")
    )


def with_retry_param(url: Column, n: Column) -> Column:
    """The parameter _retry=n: in the place of the first that is there, further ones go, else behind the others; a fragment stays last."""
    fragment = F.regexp_extract(url, r"(?s)(#.*)$", 1)
    plain = F.regexp_replace(url, r"(?s)#.*$", "")
    param = F.concat(F.lit("_retry="), n.cast("string"))
    path, query = F.substring_index(plain, "?", 1), F.regexp_extract(plain, r"(?s)\?(.*)$", 1)
    first = F.regexp_replace(query, F.lit(r"(?s)^((?:(?!_retry=)[^&]*&)*?)_retry=[^&]*"), F.concat(F.lit("$1"), F.lit("\u0001")))
    rest = F.regexp_replace(first, r"(?<=&)_retry=[^&]*(&|$)", "")
    kept = F.regexp_replace(F.replace(rest, F.lit("\u0001"), param), "&$", "")
    return F.concat(path, F.lit("?"), F.when(query == "", param).when(first.contains("\u0001"), kept).otherwise(F.concat(query, F.lit("&"), param)), fragment)


def contents_url(base: Column, exempt: tuple[str, ...] = ()) -> Column:
    """The address of the contents of a server: ends in '/', and in 'contents/' unless it is one of the ``exempt`` addresses."""
    slash = F.when(base.endswith("/"), base).otherwise(F.concat(base, F.lit("/")))
    return F.when(slash.endswith("contents/") | slash.isin(*exempt), slash).otherwise(F.concat(slash, F.lit("contents/")))


def is_world(url: Column) -> Column:
    return F.coalesce(url.contains("worlds-content-server"), F.lit(False))


def job_version(iss: Column, lods: Column, kind: Column, scene: Column, wearable: Column) -> Column:
    """The version a job is converted with; an entity that can't be looked up counts as a scene."""
    return F.when(iss, F.lit(STATIC_SCENE_VERSION)).when(lods | (scene == wearable), scene).when(kind.isin("wearable", "emote"), wearable).otherwise(scene)


def animation_method(kind: Column, setting: Column) -> Column:
    k = F.lower(kind)
    return F.when(kind.isNull(), "Legacy").when(k.contains("emote"), "Mecanim").when(k.contains("wearable"), "None").otherwise(setting)


def build_target(name: Column) -> Column:
    """Windows and Mac build names as short targets, null for others."""
    n = F.lower(name)
    return F.when(n.isin("standalonewindows64", "standalonewindows", "windows"), "windows").when(n.isin("standaloneosx", "mac"), "mac")


def default_unknown(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("unknown"))


def split_list(text: Column, sep: str = ";") -> Column:
    return F.filter(F.transform(F.split(text, sep), lambda x: F.trim(x)), lambda x: x != "")


def join_hashes(hashes: Column) -> Column:
    """Hashes joined by ';'; an error if one isn't alphanumeric."""
    return F.when(F.forall(hashes, lambda h: h.rlike(CID)), F.array_join(hashes, ";")).otherwise(F.raise_error(F.lit("bad hash in list")).cast("string"))


def option_values(args: Column, name: str, n: int) -> Column:
    """The ``n`` values behind a command-line flag; null without the flag or with fewer values."""
    at = F.array_position(args, F.lit(name))
    return F.when((at > 0) & (F.size(args) >= at + n), F.slice(args, (at + 1).cast("int"), F.lit(min(n, 100))))


def net_ticks(ts: Column) -> Column:
    """100 ns ticks since year 1."""
    return F.unix_micros(ts) * 10 + F.lit(621355968000000000)


def at_least(value: Column, least: float, default: float | None = None) -> Column:
    """A setting with a lower bound (milliseconds, workers); ``default`` stands for a missing one."""
    return F.greatest(value if default is None else F.coalesce(value, F.lit(default)), F.lit(least))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def disk_is_low(free: Column, least: int = 1_000_000_000) -> Column:
    return F.coalesce(free < least, F.lit(False))


def megabytes(size: Column) -> Column:
    """Whole mebibytes."""
    return F.floor(size / (1 << 20)).cast("bigint")


def per_asset_seconds(total: Column, n: Column) -> Column:
    """Seconds for each asset; null if there are none."""
    return F.when(n > 0, total / n)


def lod_exit_code(n_outputs: Column, exit_code: Column, empty: int = 5) -> Column:
    """A level-of-detail run that leaves no file ends with its own code, whatever the engine said."""
    return F.when(F.coalesce(n_outputs, F.lit(0)) == 0, F.lit(empty)).otherwise(exit_code)


def content_server(tld: Column, worlds: Column, domain: str, contents: str = "/content") -> Column:
    """Address of the content server of ``domain`` under a top-level domain: the peer's contents, or the worlds server."""
    zone = F.when(tld.isin("today", "zone"), tld).otherwise("org")
    return F.when(worlds, F.concat(F.lit(f"https://worlds-content-server.{domain}."), zone)).otherwise(F.concat(F.lit(f"https://peer.{domain}."), zone, F.lit(contents)))
