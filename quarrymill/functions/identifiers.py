"""Persistent identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOI = r"10\.\d{4,9}/[^\s\"'<>]+"
FUNDER_PREFIX = "10.13039/"


def strip_trailing(x: Column) -> Column:
    """Punctuation, quotes and closing brackets off the end."""
    return F.regexp_replace(x, r"""[.,;:)\\\]}>"']+$""", "")


def is_doi_part(x: Column) -> Column:
    """Whether a text is a DOI and nothing else, whatever the case of its suffix."""
    return x.rlike(r"(?i)^10\.\d{4,9}/\S+$")


def doi_of(x: Column) -> Column:
    """The DOI that a text names: an article or deposit page's own, after a resolver or scheme, or the first embedded; else NULL."""
    article = F.regexp_extract(x, r"(?i)elifesciences\.org/articles/(\d+)", 1)
    deposit = F.regexp_extract(x, r"(?i)zenodo\.org/records?/(\d+)", 1)
    found = strip_trailing(F.regexp_extract(x, rf"(?i)({DOI})", 1))
    found = F.regexp_replace(found, r"[?#].*$", "")
    return F.when(article != "", F.concat(F.lit("10.7554/eLife."), article)).when(deposit != "", F.concat(F.lit("10.5281/zenodo."), deposit)).when(found != "", found)


def all_dois(x: Column, strict: bool = False) -> Column:
    """Every DOI in a text, once each: of article pages, deposit pages, resolver links, after ``doi:``, then bare ones; ``strict`` leaves the bare ones out."""
    every = lambda p: F.regexp_extract_all(x, F.lit(p), F.lit(1))
    pages = F.concat(
        F.transform(every(r"(?i)elifesciences\.org/articles/(\d+)"), lambda n: F.concat(F.lit("10.7554/eLife."), n)),
        F.transform(every(r"(?i)zenodo\.org/records?/(\d+)"), lambda n: F.concat(F.lit("10.5281/zenodo."), n)),
    )
    parts = [every(r"(?i)https?://(?:dx\.)?doi\.org/([^?\s#<>]+)"), every(r"""(?i)doi:\s*(10\.\d{4,9}/[^\s"<>)\];:,]+)""")]
    parts += [] if strict else [every(rf"(?i)({DOI})")]
    return F.array_distinct(F.concat(pages, F.filter(F.transform(F.concat(*parts), strip_trailing), is_doi_part)))


def is_doi(x: Column) -> Column:
    return x.rlike(r"(?i)^10\.\d{4,9}/\S+$")


def is_funder(x: Column) -> Column:
    return F.coalesce(x.startswith(FUNDER_PREFIX), F.lit(False))


def doi_url(x: Column) -> Column:
    return F.concat(F.lit("https://doi.org/"), x)


def url_of(pid: Column) -> Column:
    """A link for an identifier: as it is if it is one, by scheme (in either case), or for a bare DOI; else empty."""
    last = F.element_at(F.split(pid, ":"), -1)
    scheme = lambda s: F.lower(pid).startswith(f"{s}:")
    return (
        F.when(pid.startswith("http"), pid)
        .when(scheme("ror"), F.concat(F.lit("https://ror.org/"), last))
        .when(scheme("orcid"), F.concat(F.lit("https://orcid.org/"), last))
        .when(scheme("doi"), doi_url(last))
        .when(pid.startswith("10.") & pid.contains("/"), doi_url(pid))
        .otherwise(F.lit(""))
    )


def pid_kind(x: Column) -> Column:
    """doi for a bare DOI, uri for a link, else uuid."""
    return F.when(x.rlike(r"^10\.[^./]*/"), "doi").when(x.startswith("http"), "uri").otherwise("uuid")


# Marks of addresses that name a deposit.
KNOWN = ["doi.org", "doi:", "zenodo.org", "data.jrc.ec.europa.eu", "figshare.com", "datadryad.org", "/geonetwork"]


def deposit_id(uri: Column, others: Column) -> Column:
    """The identifier in an address: that of the last of ``others`` (an array) with a known mark, else of ``uri``; unchanged where no rule applies."""
    known = F.filter(F.coalesce(others, F.array().cast("array<string>")), lambda u: F.exists(F.array(*[F.lit(k) for k in KNOWN]), lambda k: F.contains(u, k)))
    x = F.coalesce(F.try_element_at(known, F.lit(-1)), uri)
    bare = F.split_part(x, F.lit("?"), F.lit(1))
    after = lambda v, mark: F.trim(F.element_at(F.split(v, mark), -1))
    record = F.regexp_extract(bare, r"/record/([^/]+)", 1)
    dryad = F.regexp_extract(bare, r"/dataset/([^/]+)", 1)
    figure = F.regexp_extract(bare, r"/articles/[^/]+/([^/]+)", 1)
    return (
        F.when(x.contains("doi.org"), after(bare, r"doi\.org/"))
        .when(x.contains("oai-zenodo-org-"), F.concat(F.lit("10.5281/zenodo."), F.element_at(F.split(x, "oai-zenodo-org-"), 2)))
        .when(x.contains("zenodo.org"), F.when(record != "", F.concat(F.lit("10.5281/zenodo."), record)).otherwise(x))
        .when(x.contains("doi:"), after(x, "doi:"))
        .when(x.contains("data.jrc.ec.europa.eu") | x.contains("/geonetwork"), after(bare, "/"))
        .when(x.contains("figshare.com") & (figure != ""), F.concat(F.lit("10.6084/m9.figshare."), figure))
        .when(x.contains("datadryad.org") & (dryad != ""), F.concat(F.lit("10.5061/dryad."), dryad))
        .otherwise(x)
    )


def video_id(url: Column) -> Column:
    """(kind, id) of a video link: a playlist, a watch page or a short link; NULL for others."""
    of = lambda p: F.regexp_extract(url, p, 1)
    pair = lambda kind, x: F.struct(F.lit(kind).alias("kind"), x.alias("id"))
    lists, watch, short = of(r"[?&]list=([^&#]+)"), of(r"[?&]v=([^&#]+)"), of(r"youtu\.be/([^?&#/]+)")
    return F.when(lists != "", pair("playlist", lists)).when(watch != "", pair("video", watch)).when(short != "", pair("video", short))


def last_part(x: Column, sep: str = "/") -> Column:
    return F.element_at(F.split(x, sep), -1)


def record_key(x: Column) -> Column:
    """What follows ``items/``, up to an underscore."""
    return F.split_part(F.element_at(F.split(x, "items/"), -1), F.lit("_"), F.lit(1))


# Marks of landing-page hosts and the repository of each; the first that occurs in the host wins.
REPOSITORIES = [
    ("zenodo.org", "zenodo"), ("dataverse", "dataverse"), ("recherche.data.gouv.fr", "dataverse"), ("datadryad.org", "dryad"), ("onlinelibrary.wiley.com", "wiley"),
    ("link.springer.com", "springer"), ("sciencedirect.com", "sciencedirect"), ("elsevier.com", "sciencedirect"), ("pubs.acs.org", "acs"), ("pubs.rsc.org", "rsc"),
    ("nature.com", "nature"), ("pnas.org", "pnas"), ("pangaea.de", "pangaea"), ("handle.net", "dspace"), ("dspace", "dspace"),
]


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def repository(url: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    out = None
    for part, name in rules or REPOSITORIES:
        hit = host(url).contains(part)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("unknown")


def page_links(html: Column, words: list[str]) -> Column:
    """Link targets of a page that contain any of ``words``, once each, in order."""
    hrefs = F.regexp_extract_all(html, F.lit(r"""href\s*=\s*["']([^"']+)["']"""), F.lit(1))
    hit = lambda h: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.lower(h), w))
    return F.array_distinct(F.filter(hrefs, hit))


def join_url(base: Column, target: Column) -> Column:
    """A link target made absolute against its page."""
    scheme, root = F.regexp_extract(base, r"^([a-zA-Z]+):", 1), F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]+)", 1)
    folder = F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]+(?:/[^?#]*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(target.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .otherwise(F.concat(folder, target))
    )
