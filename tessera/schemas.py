"""The tables of the engine. Coordinates are whole numbers: 1e-7 degrees (lat, lng) before
projection, Mercator centimetres (x, y) after it."""

TAGS = "map<string,string>"
NODES = f"id bigint, version int, lat int, lng int, tags {TAGS}"
WAYS = f"id bigint, version int, refs array<struct<pos:int,id:bigint,lat:int,lng:int>>, tags {TAGS}"
RELATIONS = f"id bigint, version int, members array<struct<pos:int,type:string,ref:bigint,role:string>>, tags {TAGS}"
REVERSE_REFS = "target_type string, target_id bigint, src_type string, src_id bigint"
POINT = "struct<x:int,y:int>"
RINGS = f"array<array<{POINT}>>"
MULTIPOLYGONS = f"rel_id bigint, poly_no int, rings {RINGS}, way_ids array<bigint>, tags {TAGS}"
#: One record of a file of entities, whichever kind.
ENTITIES = f"entity string, id bigint, version int, lat int, lng int, refs array<bigint>, members array<struct<type:string,ref:bigint,role:string>>, tags {TAGS}"
CHANGES = f"change string, {ENTITIES}"
