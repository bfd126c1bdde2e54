"""Tag maps as expressions: lookups, the ingest blacklist, merges and the boundary fold."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys that ingest drops, and beginnings of keys that it drops.
DROPPED_KEYS = (
    "created_by", "converted_by", "note", "comment", "source", "FIXME", "fixme", "AND", "attribution",
    "addr:city:simc", "addr:street:simc", "addr:street:sym_ul", "addr:postcode:source", "build",
    "building:type:pl", "building:usage:pl", "building:use:pl", "chicago:building_id", "cladr:code", "cxx:code",
    "cxx:id", "de:amtlicher_gemeindeschluessel", "description", "dcgis", "dibavod:id", "educamadrid", "FLATE",
    "fresno_APN", "fresno_lot_width", "fresno_lot_depth", "fresno_lot_area", "fresno_TX_area_CD", "geonames_id",
    "gnis", "GoeVB:id", "gtfs_id", "IBNR", "ID:tobwen", "ID_SLH_IMPORT", "idee:name", "import", "import_uuid",
    "koatuu", "linz2osm:objectid", "lot_description", "lojic:bgnum", "mvdgis:padron", "mvdgis:cod_nombre",
    "nycdoitt:bin", "odbl", "onkz", "project:eurosha_2012", "ref:bag", "ref:bagid", "ref:INSEE",
    "ref:SIREN", "ref:UrbIS", "ref:old", "SK53_bulk:load", "source_ref", "statscan:rbuid",
    "tiger 2010:way_id", "tiger.source:tlid", "tiger name", "tiger_base", "tiger_name_type", "tiger-reviewed",
    "uic_ref", "uir_adr:ADRESA_KOD", "us.fo:Adressutal", "usar_addr:edit_date",
)
DROPPED_PREFIXES = (
    "AND_", "AND:", "bag:", "b5m:", "bak:", "building:ruian:", "canvec:",
    "cladr:", "CLC:", "comment:", "dcgis:", "description:",
    "dibavod:", "educamadrid:", "ewmapa:", "fixme:", "FIXME:", "geobase:", "GeoBaseNHN:", "gns_", "gns:", "GNS:",
    "GNIS:", "gnis:", "gst:", "ideewfs:", "it:fvg:", "it:lo:", "it:pv:", "kms:", "KSJ2:", "lbcs:", "LINZ:",
    "LINZ2OSM:", "linz:", "maaamet:", "massgis:", "mvdgis:", "naptan:", "ngbe:", "NHD_", "NHD-", "NHD:", "nhd_",
    "nhd-", "nhd:", "note:", "openGeoDB:", "opengeodb:", "osak:", "rednap:", "ref:ruian", "ref:FR:",
    "ref:opendataparis:", "semnav:", "siruta:", "surrey:", "source:", "source_ref:", "teryt:", "tiger:", "TIGER:",
    "TMC:cid_58:", "USGS-LULC:", "VRS:", "WroclawGIS:", "yh:",
)
#: The admin level of a boundary that has none, or none that is a number.
NO_LEVEL = 0xFFFF

_DROPPED = "^(?:" + "|".join(map(re.escape, DROPPED_PREFIXES)) + ")"


def has(tags: Column, key: str) -> Column:
    """Whether the key is present; a null map has none."""
    return F.coalesce(F.map_contains_key(tags, key), F.lit(False))


def value(tags: Column, key: str) -> Column:
    """The value, empty where the key is absent."""
    return F.coalesce(tags[key], F.lit(""))


def dropped(key: Column) -> Column:
    """Whether ingest drops a key: one set lookup and one anchored match."""
    return key.isin(*DROPPED_KEYS) | key.rlike(_DROPPED)


def kept(tags: Column) -> Column:
    """The map without the keys that ingest drops."""
    return F.map_filter(tags, lambda k, v: ~dropped(k))


def from_pairs(pairs: Column) -> Column:
    """A map of an array of (k, v) structs, the first of repeated keys winning."""
    keys = F.transform(pairs, lambda p: p["k"])
    first = F.filter(pairs, lambda p, i: F.array_position(keys, p["k"]) == i + 1)
    return F.map_from_entries(first)


def without(tags: Column, *keys: str) -> Column:
    return F.map_filter(tags, lambda k, v: ~k.isin(*keys))


def overwritten(base: Column, over: Column) -> Column:
    """Union in which `over` wins."""
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(over, k)), over)


def filled(base: Column, more: Column) -> Column:
    """Union in which `base` wins."""
    return overwritten(more, base)


def in_all(maps: Column) -> Column:
    """Entries that every map of an array has alike; an empty array gives null."""
    rest = F.slice(maps, 2, F.greatest(F.size(maps) - 1, F.lit(0)))
    return F.aggregate(rest, F.try_element_at(maps, F.lit(1)), lambda a, m: F.map_filter(a, lambda k, v: F.map_contains_key(m, k) & (m[k] == v)))


def truthy(text: Column) -> Column:
    return text.isin("true", "yes", "1")


def leading_int(text: Column) -> Column:
    """The whole number that a text starts with, 0 where it starts with none."""
    return F.coalesce(F.regexp_extract(text, r"^\s*([+-]?\d+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def digits_or(text: Column, default: int) -> Column:
    """The number of a text of digits only (none: 0), else the default."""
    number = F.coalesce(F.nullif(text, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.when(text.rlike("^[0-9]*$"), number).otherwise(F.lit(default).cast("bigint"))


def admin_level(tags: Column) -> Column:
    return F.when(has(tags, "admin_level"), digits_or(tags["admin_level"], NO_LEVEL)).otherwise(F.lit(NO_LEVEL).cast("bigint"))


def with_boundaries(tags: Column, boundaries: Column) -> Column:
    """Tags after taking over those of an array of boundary tag maps, in its order.

    A boundary at least as important as any so far overwrites, a lesser one only fills in.
    """
    start = F.struct(admin_level(tags).alias("level"), tags.alias("tags"))

    def step(acc, boundary):
        own, level = without(boundary, "type"), admin_level(boundary)
        merged = F.when(level <= acc["level"], overwritten(acc["tags"], own)).otherwise(filled(acc["tags"], own))
        return F.struct(F.least(acc["level"], level).alias("level"), merged.alias("tags"))

    return F.aggregate(boundaries, start, step, lambda acc: acc["tags"])
