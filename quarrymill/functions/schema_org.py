"""Records as schema.org fields: maps of field to values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Catalogue fields and the schema.org field of each.
FIELDS = {
    "title": "name", "abstract": "description", "id": "identifier", "published": "datePublished", "authors": "creator", "author": "creator", "issued": "datePublished",
    "created": "dateCreated", "modified": "dateModified", "subject": "keywords",
}


def merged(record: Column, fields: dict[str, str] | None = None) -> Column:
    """A record (field to values) with its fields renamed; values of fields that meet are appended, target first, empty ones left out.

    Context, type, identifier and address get their defaults; without any, the identifier is a
    digest of the record.
    """
    fields = fields or FIELDS
    none = F.array().cast("array<string>")
    values = lambda k: F.filter(F.coalesce(F.try_element_at(record, F.lit(k)), none), lambda v: v.isNotNull() & (v != ""))
    targets = list(dict.fromkeys(fields.values()))
    parts = [F.struct(F.lit(t).alias("key"), F.concat(values(t), *[values(k) for k, v in fields.items() if v == t and k != t]).alias("value")) for t in targets]
    rest = F.filter(F.map_entries(record), lambda e: ~e["key"].isin([*fields, *targets]))
    entries = F.filter(F.concat(F.array(*parts), rest), lambda e: F.size(e["value"]) > 0)
    out = F.map_from_entries(entries)
    first = lambda m, k: F.get(F.try_element_at(m, F.lit(k)), F.lit(0))
    key = F.coalesce(first(out, "identifier"), first(out, "@id"), first(out, "url"), F.md5(F.to_json(record)))
    address = F.coalesce(first(out, "@id"), first(out, "url"), key)
    given = F.map_filter(out, lambda k, v: ~k.isin("identifier", "@id"))
    defaults = [(k, F.coalesce(F.try_element_at(out, F.lit(k)), F.array(F.lit(v)))) for k, v in (("@context", "https://schema.org"), ("@type", "CreativeWork"))]
    given = F.map_filter(given, lambda k, v: ~k.isin("@context", "@type"))
    return F.map_concat(given, F.create_map(*[x for k, v in defaults for x in (F.lit(k), v)], F.lit("identifier"), F.array(key), F.lit("@id"), F.array(address)))
