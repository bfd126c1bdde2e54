"""Map files in PBF and XML, change files and the stream of changes."""

import pytest
from pyspark.sql import functions as F

from tessera.sources import pbf, xml
from tessera.streaming import changes


def small(writer: pbf.PbfWriter) -> bytes:
    writer.node(1, 525200000, 134050000, {"name": "Bär", "place": "city"}, 3)
    writer.node(2, -338688000, 1512093000)
    writer.node(7, 0, 0, {"source": "x"})
    first = writer.flush()
    writer.way(10, [1, 2, 7, 1], {"highway": "road"}, 2)
    writer.relation(20, [("WAY", 10, "outer"), ("NODE", 7, ""), ("RELATION", 20, "self")], {"type": "multipolygon"})
    return writer.header() + first + writer.flush()


@pytest.mark.parametrize("dense,compress,granularity", [(True, True, 100), (True, False, 100), (False, True, 100), (True, True, 1000)])
@pytest.mark.parametrize("split", [1, 1 << 20])
def test_pbf(spark, tmp_path, dense, compress, granularity, split):
    path = tmp_path / "a.pbf"
    path.write_bytes(small(pbf.PbfWriter(dense, compress, granularity)))
    rows = {(r.entity, r.id): r for r in pbf.read(spark, str(path), split).collect()}
    assert sorted(rows) == [("NODE", 1), ("NODE", 2), ("NODE", 7), ("RELATION", 20), ("WAY", 10)]
    assert (rows["NODE", 1].lat, rows["NODE", 1].lng, rows["NODE", 1].version) == (525200000, 134050000, 3)
    assert (rows["NODE", 2].lat, rows["NODE", 2].lng, rows["NODE", 2].tags) == (-338688000, 1512093000, {})
    assert rows["NODE", 1].tags == {"name": "Bär", "place": "city"}
    assert rows["WAY", 10].refs == [1, 2, 7, 1] and rows["WAY", 10].version == 2
    assert [tuple(m) for m in rows["RELATION", 20].members] == [("WAY", 10, "outer"), ("NODE", 7, ""), ("RELATION", 20, "self")]


def test_pbf_without_tags_has_no_delimiters(spark, tmp_path):
    writer = pbf.PbfWriter()
    for i in range(1, 5):
        writer.node(i, i, -i)
    (tmp_path / "a.pbf").write_bytes(writer.flush())
    assert [r.tags for r in pbf.read(spark, str(tmp_path)).collect()] == [{}] * 4


@pytest.mark.parametrize("data", [b"\0\0\0", b"\xff\xff\xff\xff", small(pbf.PbfWriter())[:-9], pbf.PbfWriter().frame("Other", b"")])
def test_broken_pbf_is_refused(tmp_path, data):
    path = tmp_path / "a.pbf"
    path.write_bytes(data)
    with pytest.raises(Exception):  # noqa: B017
        reader = pbf.PbfReader({"path": str(path)})
        for part in reader.partitions():
            list(reader.read(part))


OSM = """<?xml version='1.0'?><osm version="0.6"><!-- c -->
<node id="1" version="2" lat="52.52" lon="-12.5"><tag k="name" v="A &amp; B"/></node>
<node id="2" lat="0" lon="0"/>
<way id="5" version="1"><nd ref="1"/><nd ref="2"/><tag k="highway" v="road"/><tag k="highway" v="again"/></way>
<way id="6" version="1"><tag k="a" v="b"/></way>
<relation id="9" version="4"><member type="way" ref="5" role="outer"/></relation>
<relation id="10"/></osm>"""


def test_xml(spark, tmp_path):
    path = str(tmp_path / "a.osm")
    (tmp_path / "a.osm").write_text(OSM)
    nodes = {r.id: r for r in xml.nodes(spark, path).collect()}
    assert (nodes[1].lat, nodes[1].lng, nodes[1].version, nodes[1].tags) == (525200000, -125000000, 2, {"name": "A & B"})
    assert (nodes[2].lat, nodes[2].version, nodes[2].tags) == (0, 1, {})
    (way,) = xml.ways(spark, path).collect()
    assert way.id == 5 and [r.id for r in way.refs] == [1, 2] and way.tags == {"highway": "road"}
    (rel,) = xml.relations(spark, path).collect()
    assert rel.id == 9 and tuple(rel.members[0]) == (1, "WAY", 5, "outer")


CHANGE = """<osmChange version="0.6"><create><node id="1" version="1" lat="1" lon="2"><tag k="a" v="b"/></node><way id="5" version="1"><nd ref="1"/></way></create>
<modify><node id="2" version="3" lat="1.5" lon="2"/></modify><delete><relation id="9" version="4"><member type="way" ref="5" role=""/></relation><node id="3" version="2" lat="0" lon="0"/></delete></osmChange>"""


def test_change_file(spark, tmp_path):
    (tmp_path / "a.osc").write_text(CHANGE)
    rows = xml.changes(spark, str(tmp_path / "a.osc"))
    assert {(r.change, r.entity): r.n for r in changes.counts(rows).collect()} == {("create", "NODE"): 1, ("create", "WAY"): 1, ("modify", "NODE"): 1, ("delete", "RELATION"): 1, ("delete", "NODE"): 1}
    node = rows.where("change = 'modify'").first()
    assert (node.id, node.version, node.lat, node.lng) == (2, 3, 15000000, 20000000)
    assert rows.where("entity = 'WAY'").first().refs == [1]


def change_rows(spark, rows):
    from tessera.schemas import CHANGES

    return spark.createDataFrame([(c, "NODE", i, v, 0, 0, None, None, {"v": str(v)}) for c, i, v in rows], CHANGES)


def test_latest_and_applied(spark):
    state = change_rows(spark, [("create", 1, 1), ("create", 2, 5), ("create", 3, 1)])
    new = change_rows(spark, [("modify", 1, 2), ("modify", 1, 3), ("modify", 2, 4), ("delete", 3, 2), ("create", 4, 1)])
    after = changes.applied(state, new)
    assert {r.id: r.version for r in changes.live(after).collect()} == {1: 3, 2: 5, 4: 1}
    again = changes.applied(after, change_rows(spark, [("modify", 3, 1), ("create", 4, 2)]))
    assert {r.id: r.version for r in changes.live(again).collect()} == {1: 3, 2: 5, 4: 2}


def test_stream_keeps_the_latest(spark, tmp_path):
    source, state, check = (str(tmp_path / x) for x in ("in", "state", "check"))
    change_rows(spark, [("create", 1, 1), ("create", 2, 1)]).write.parquet(source)
    changes.stream(spark, source, state, check).awaitTermination()
    change_rows(spark, [("modify", 1, 2), ("delete", 2, 2)]).write.mode("append").parquet(source)
    changes.stream(spark, source, state, check).awaitTermination()
    assert [(r.id, r.version) for r in changes.current(spark, state).collect()] == [(1, 2)]


def test_late_changes_do_not_bring_back_what_is_deleted(spark, tmp_path):
    import os

    source, state, check = (str(tmp_path / x) for x in ("in", "state", "check"))
    for rows in ([("create", i, 1) for i in range(40)], [("delete", 7, 5), ("modify", 8, 2)], [("modify", 7, 4), ("create", 99, 1)], [("modify", 8, 3)]):
        change_rows(spark, rows).write.mode("append").parquet(source)
        changes.stream(spark, source, state, check).awaitTermination()
    got = {r.id: r.version for r in changes.current(spark, state).collect()}
    assert got == {i: 3 if i == 8 else 1 for i in [*range(40), 99] if i != 7}
    kept = [n for n in sorted(os.listdir(state)) if n.isdigit()]
    buckets = [{b for b in os.listdir(f"{state}/{n}") if b.startswith("bucket=")} for n in kept]
    assert len(buckets[-1]) == 1 and all(sum(b in own for own in buckets) <= 2 for b in set().union(*buckets))


def test_written_files_read_alike_in_either_way(spark, tmp_path, sf_dir):
    from tessera.sources import bridge

    rows, path = bridge.entities(spark, sf_dir), str(tmp_path / "map")
    pbf.write(rows, path)
    as_text = lambda df: sorted(str((r.entity, r.id, r.version, r.lat, r.lng, r.refs, r.members or None, sorted((r.tags or {}).items()))) for r in df.collect())
    want = as_text(rows)
    assert as_text(pbf.read(spark, path)) == want and as_text(pbf.read_whole(spark, path)) == want
    assert as_text(pbf.read(spark, path, split=1000)) == want


def test_dirty(spark):
    reverse = spark.createDataFrame([("NODE", 1, "WAY", 5), ("WAY", 5, "RELATION", 9), ("NODE", 2, "WAY", 6)], "target_type string, target_id long, src_type string, src_id long")
    found = changes.dirty(reverse, spark.createDataFrame([("NODE", 1)], "entity string, id long"))
    assert sorted(map(tuple, found.collect())) == [("RELATION", 9), ("WAY", 5)]


def test_empty_changes(spark):
    none = change_rows(spark, []).where(F.lit(False))
    assert changes.latest(none).count() == 0 and changes.counts(none).count() == 0
