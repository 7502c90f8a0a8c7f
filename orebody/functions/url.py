"""Web addresses: the registrable domain of a site, and the normal forms in which pages and profiles are compared.

Addresses are taken apart and put together in the JVM. Only host names cross to Python: those outside ASCII for their
IDNA form, and each distinct one of a batch for its place in the list of public suffixes, which has some ten thousand rules.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A file in the format of the public suffix list, read where the plan is made, so that all executors follow one list;
# where there is none, the rules below hold alone.
SUFFIX_FILE = os.environ.get("PUBLIC_SUFFIX_FILE", "/usr/share/publicsuffix/public_suffix_list.dat")
# Suffixes known without a file, the reserved ones among them.
KNOWN_SUFFIXES = (
    "com org net edu gov mil int info biz io ai co me us ca uk de fr es it nl eu au nz sg hk in za jp mx br cl ar ch at be se no dk fi pl pt ie cz hu ro gr tr kr cn tw"
    " co.uk org.uk ac.uk gov.uk com.au net.au org.au co.nz co.jp com.mx com.br co.in co.za com.sg com.hk qc.ca on.ca wixsite.com example test invalid"
)
# Sites that list many companies.
SHARED_SITES = (
    "linkedin.com", "facebook.com", "instagram.com", "x.com", "twitter.com", "youtube.com", "google.com", "yelp.com", "yellowpages.com",
    "yellowpages.ca", "mapquest.com", "crunchbase.com", "bloomberg.com", "zoominfo.com", "dnb.com", "pitchbook.com", "opencorporates.com",
)
_LABEL = r"[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"
_ADDRESS = r"(?is)^(https?)://([^/?#@:\[\]\\]+)(?::([0-9]*))?(/[^?#]*)?(?:\?([^#]*))?(?:#.*)?$"


@F.arrow_udf(T.StringType())
def _idna(hosts: pa.Array) -> pa.Array:
    def ascii_form(host: str | None) -> str | None:
        try:
            return host and ".".join(label.encode("idna").decode("ascii") for label in host.casefold().split("."))
        except UnicodeError:
            return None

    return pa.array([ascii_form(h) for h in hosts.to_pylist()], pa.string())


def _ascii_host(host: Column) -> Column:
    plain = ~host.rlike(r"[^\x00-\x7F]")
    return F.coalesce(F.when(plain, F.lower(host)), _idna(F.when(~plain, host)))


def _parts(url: Column) -> Column:
    """Scheme, host, port, path and query of an http(s) address without user information and with a proper port, as an
    array, '' for a part that is not there; null for anything else."""
    clean = F.regexp_replace(url, r"^[\s\x1c-\x1f\u0085\p{Z}]+|[\s\x1c-\x1f\u0085\p{Z}]+\z|[\t\r\n]", "")
    split = F.split(F.regexp_replace(clean, _ADDRESS, "$1\x01$2\x01$3\x01$4\x01$5"), "\x01")
    return _bound(split, lambda s: F.when((F.size(s) == 5) & ((s[2] == "") | (F.length(s[2]) <= 9) & (s[2].try_cast("int") <= 65535)), s))


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


@lru_cache(maxsize=4)
def _rules(path: str) -> tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]:
    """(suffixes, parents of any label, names that are none although their parent says so) of the list in a file."""
    plain, any_below, never = {*KNOWN_SUFFIXES.split()}, set(), set()
    if os.path.exists(path):
        with open(path, encoding="utf-8") as lines:
            for line in lines:
                rule = line.split("//")[0].strip()
                kind = any_below if rule.startswith("*.") else never if rule.startswith("!") else plain
                try:
                    kind.add(".".join(x.encode("idna").decode() for x in rule.lstrip("*!").lstrip(".").split(".")))
                except UnicodeError:
                    continue
    return tuple(sorted(plain - {""})), tuple(sorted(any_below)), tuple(sorted(never))


def registrable_domain(url: Column, path: str = SUFFIX_FILE) -> Column:
    """The label below the longest public suffix, with that suffix; null for numeric addresses, local names, unknown
    suffixes, labels that no host may have, and for what is no http(s) address."""
    plain, any_below, never = map(frozenset, _rules(path))

    def below(host: str | None) -> str | None:
        if host is None:
            return None
        ends = [host]  # the host, then what is left of it without its first labels
        while "." in ends[-1]:
            ends.append(ends[-1].partition(".")[2])
        for k, end in enumerate(ends):
            if end in never:
                return end
            if end in plain or k + 1 < len(ends) and ends[k + 1] in any_below:
                return ends[k - 1] if k else None
        return None

    @F.arrow_udf(T.StringType())
    def run(hosts: pa.Array) -> pa.Array:
        coded = pc.dictionary_encode(hosts)
        return pa.array(map(below, coded.dictionary.to_pylist()), pa.string()).take(coded.indices)

    host = F.regexp_replace(_ascii_host(_parts(url)[1]), r"\.+\z", "")
    return run(F.when(host.rlike(rf"^{_LABEL}(?:\.{_LABEL})+\z"), host))


def company_domain(url: Column) -> Column:
    """The registrable domain unless it is a shared site's."""
    domain = registrable_domain(url)
    return F.when(~domain.isin(*SHARED_SITES), domain)


def page_url(url: Column) -> Column:
    """Scheme and host in lower case, ASCII host, a path at least '/', the query, no fragment; null for what is no http(s)
    address by name."""
    def put(p: Column) -> Column:
        port = F.when(p[2] != "", F.concat(F.lit(":"), p[2].cast("int").cast("string"))).otherwise("")
        return F.concat(port, F.coalesce(F.nullif(p[3], F.lit("")), F.lit("/")), F.when(p[4] != "", F.concat(F.lit("?"), p[4])).otherwise(""))

    parts = _parts(url)
    return F.concat(F.lower(parts[0]), F.lit("://"), _ascii_host(parts[1]), _bound(parts, put))


def profile_url(url: Column) -> Column:
    """A profile as https, without www., port, query, fragment, doubled and trailing slashes; null as for page_url."""
    def put(p: Column) -> Column:
        host = F.regexp_replace(F.regexp_replace(F.lower(p[1]), r"\.+\z", ""), r"^www\.", "")
        path = F.regexp_replace(F.regexp_replace(p[3], "/+", "/"), r"/\z", "")
        return F.concat(F.lit("https://"), host, F.coalesce(F.nullif(path, F.lit("")), F.lit("/")))

    return _bound(_parts(url), put)
