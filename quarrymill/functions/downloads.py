"""Direct file links: by the address of a landing page, by a repository's answer, and by what a page declares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .identifiers import repository

# Fixed value: the host that serves files of one publisher, whatever the page's own host is.
WILEY_FILES = "https://agupubs.onlinelibrary.wiley.com/doi/pdf/"


def _after(x: Column, mark: str) -> Column:
    """What follows the last ``mark``; NULL without one."""
    return F.when(x.contains(mark), F.substring_index(x, mark, -1))


def _root(url: Column) -> Column:
    return F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)


def files_of(url: Column) -> Column:
    """File links that follow from a landing page's own address; an empty array where the address lacks the mark."""
    by, doi, none = repository(url), _after(url, "/doi/"), F.array().cast("array<string>")
    item = F.regexp_extract(url, r"/pii/([A-Z0-9]+)", 1)
    link = (
        F.when(by == "wiley", F.concat(F.lit(WILEY_FILES), doi))
        .when(by == "springer", F.concat(_root(url), F.lit("/content/pdf/"), _after(url, "/article/"), F.lit(".pdf")))
        .when(by == "sciencedirect", F.when(item != "", F.concat(_root(url), F.lit("/science/article/pii/"), item, F.lit("/pdfft"))))
        .when(by.isin("acs", "pnas"), F.concat(_root(url), F.lit("/doi/pdf/"), doi))
        .when((by == "rsc") & url.contains("/articlelanding/"), F.replace(url, F.lit("/articlelanding/"), F.lit("/articlepdf/")))
        .when(by == "nature", F.concat(_root(url), F.lit("/articles/"), _after(url, "/articles/"), F.lit(".pdf")))
    )
    return F.when(link.isNotNull(), F.array(link)).otherwise(none)


def answer_address(url: Column) -> Column:
    """Where a repository lists the files of a landing page, to be looked up in a cache; NULL for others."""
    by = repository(url)
    given = _after(url, "persistentId=")
    return (
        F.when(by == "zenodo", F.concat(F.lit("https://zenodo.org/api/records/"), F.substring_index(F.regexp_replace(url, "/+$", ""), "/", -1)))
        .when(by == "dryad", F.concat(F.lit("https://datadryad.org/api/v2/datasets/"), F.substring_index(url, "doi.org/", -1)))
        .when(by == "dataverse", F.concat(F.substring_index(url, "/dataset", 1), F.lit("/api/datasets/:persistentId/?persistentId="), given))
    )


def files_of_answer(url: Column, answer: Column) -> Column:
    """File links in a repository's answer (JSON) for a landing page; an empty array where there are none."""
    by, none = repository(url), F.array().cast("array<string>")
    zenodo = F.from_json(answer, "files array<struct<links:struct<self:string>>>")["files"]
    dryad = F.from_json(answer, "_embedded struct<files:array<struct<_links:struct<self:struct<href:string>>>>>")["_embedded"]["files"]
    verse = F.from_json(answer, "data struct<latestVersion:struct<files:array<struct<dataFile:struct<id:bigint>>>>>")["data"]["latestVersion"]["files"]
    base = F.substring_index(url, "/dataset", 1)
    links = (
        F.when(by == "zenodo", F.transform(zenodo, lambda f: f["links"]["self"]))
        .when(by == "dryad", F.transform(dryad, lambda f: f["_links"]["self"]["href"]))
        .when(by == "dataverse", F.transform(verse, lambda f: F.concat(base, F.lit("/api/access/datafile/"), f["dataFile"]["id"].cast("string"))))
    )
    return F.coalesce(F.filter(links, lambda x: x.isNotNull()), none)


def _attribute(tag: Column, name: str) -> Column:
    value = F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*(?:"([^"]*)"|'([^']*)')""", 1)
    return F.when(value != "", value).otherwise(F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*'([^']*)'""", 1))


def declared_files(html: Column) -> Column:
    """What a page declares: its ``citation_pdf_url`` if that is given, else the downloads of its JSON-LD distributions, once each."""
    metas = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)(<meta\b[^>]*>)"), F.lit(1)), lambda t: _attribute(t, "name") == "citation_pdf_url")
    # the first such tag counts, and only if it has a content
    pdf = F.transform(F.slice(metas, 1, 1), lambda t: _attribute(t, "content"))
    scripts = F.regexp_extract_all(html, F.lit(r"""(?is)<script\b[^>]*\btype\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))
    nodes = lambda s: F.from_json(F.when(F.trim(s).startswith("["), s).otherwise(F.concat(F.lit("["), s, F.lit("]"))), "array<struct<distribution:array<string>>>")
    spread = lambda xs, f, kind: F.flatten(F.transform(xs, lambda x: F.coalesce(f(x), F.array().cast(kind))))
    entries = spread(spread(scripts, nodes, "array<struct<distribution:array<string>>>"), lambda n: n["distribution"], "array<string>")
    links = spread(entries, lambda d: F.array(F.get_json_object(d, "$.contentUrl"), F.get_json_object(d, "$.downloadUrl")), "array<string>")
    found = F.array_distinct(F.filter(links, lambda x: x.isNotNull()))
    return F.when(F.size(F.filter(pdf, lambda p: p != "")) > 0, pdf).otherwise(found)
