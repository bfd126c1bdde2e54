"""Quality, WARC, personal data, top-k, shards, near copies, rules and the pipeline against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import contract, pii, quality, rules, sharding, simhash, topk, warc
from tessera.llm.components import components


def held(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 0


# Quality


def test_op4_is_right_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = contract.op4_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    right = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert len(right) > 40 and sum(right) / len(right) >= 0.95


def test_prior_and_risk():
    rng = np.random.default_rng(1)
    make = lambda n, mean: rng.normal(mean, 1, (n, quality.N_FEATURES))
    positive = make(600, 1.0)
    unlabelled = np.concatenate([make(1400, 1.0), make(600, -1.0)])
    prior = quality.class_prior(positive, unlabelled)
    assert abs(prior - 0.7) < 0.1
    net = quality.train(positive, unlabelled, prior)
    assert (net.score(make(300, 1.0)) > 0.5).mean() > 0.95 and (net.score(make(300, -1.0)) < 0.5).mean() > 0.95


def test_odd_rows_have_scores(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (5, 1), (5, 0), (6, None), (None, 1), (14, 1)], "doc_id long, quality int")
    rows = quality.classify(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.classify(odd, labels.where("quality = 5")).collect()} == {0.5}
    assert quality.classify(none, labels).count() == 0
    kept = quality.accepted(odd, labels.where("false"))
    assert kept.columns == odd.columns and kept.count() == odd.count()


# WARC


def brute_pages(rows):
    top = {}
    for page, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000:
            digest = hashlib.sha1(data).hexdigest()
            top[digest] = max(top.get(digest, page), page)
    out = {}
    for page, html in rows:
        data = (html or "").encode()
        digest = hashlib.sha1(data).hexdigest()
        response = len(data) < 1000 or top[digest] == page
        out[page] = (len(data), digest, "response" if response else "revisit", None if response else top[digest])
    return out


def test_op5_equals_brute_force(spark, sf_dir):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in contract.op5_warc(spark, sf_dir).collect()}
    assert got == brute_pages(rows)


def test_captures_hold_their_records(spark):
    big = "é<p>\r\n\r\nWARC/1.1\r\n\r\n" * 100
    pages = [(1, "http://a.org/x?y", big), (2, "https://b.org", big), (3, None, None), (4, "http://c.org/\r\nevil: 1", "\n\r\n" * 9), (5, "http://d.org", big), (6, "x", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    rows = {r.page_id: r for r in warc.archive(df).collect()}
    assert {k: (r.response.payload_bytes, r.response.payload_digest, r.response.type, r.refers_to_page) for k, r in rows.items()} == brute_pages([(p, h) for p, _, h in pages])
    for page, _, html in pages:
        payload = rows[page].response.payload
        assert payload is None if page in (1, 2) else bytes(payload).decode() == (html or "")
    assert rows[1].response.refers_to == rows[5].response.record_id and rows[1].capture_id == rows[1].response.record_id
    assert rows[1].request.http.startswith("GET /x?y HTTP/1.1\r\nHost: a.org") and rows[4].target == "http://c.org/evil: 1"
    assert len({r.capture_id for r in rows.values()}) == len(pages)


def test_repeated_and_missing_pages(spark):
    big = "z" * 2000
    df = spark.createDataFrame([(1, "a", big), (1, "a", big), (None, "b", big), (None, None, "s"), (None, None, "s")], "page_id long, url string, html string")
    rows = warc.archive(df).collect()
    assert len(rows) == 5
    assert Counter((r.page_id, r.response.type, r.refers_to_page) for r in rows) == {(1, "response", None): 1, (1, "revisit", 1): 1, (None, "revisit", 1): 1, (None, "response", None): 2}
    assert warc.archive(df.where("false")).count() == 0


def test_files_are_archives(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://x.org/{i}", f"page {i}") for i in range(20)], "page_id long, url string, html string")
    warc.write(df, str(tmp_path / "w"), compression="none")
    kinds = Counter()
    for f in (tmp_path / "w").glob("part-*"):
        kinds.update(h["warc-type"] for h, _ in warc.parse(f.read_bytes()))
    assert kinds == {"request": 20, "response": 20, "metadata": 20}
    with pytest.raises(ValueError):
        list(warc.parse(b"HTTP/1.1 200 OK\r\n\r\n"))


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")), "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}
            if fine[kind]:
                out[kind].append(m.span())
    return out


def test_op6_keeps_the_base(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = 0
    for r in contract.op6_pii(spark, sf).collect():
        want = brute_spans(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(want[k]) for k in pii.KINDS)
        listed = [f"{k}:{a}:{b}" for k in pii.KINDS for a, b in want[k]]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) | {""}
        found += len(listed)
    assert found > 20


def test_base_equals_the_patterns():
    rng = np.random.default_rng(5)
    letters = "aZ09.%+-@@..  ()1234567,"
    for _ in range(20000):
        text = "".join(rng.choice(list(letters), rng.integers(0, 30)))
        assert pii.base(text) == brute_spans(text)


@pytest.mark.parametrize(
    "text,kind",
    [("call (614) 555-8001 now", "phone"), ("write to ann.lee [at] mail [dot] org please", "email"), ("card 4111.1111.1111.1111 was", "card"), ("host 10[.]1[.]2[.]3 is", "ip")],
)
def test_the_model_adds_spans(text, kind):
    base, added = pii.find(text, pii.trained())
    assert not any(base.values()) and [k for k, _, _ in added] == [kind]
    assert pii.redact(text, pii.trained()).count(f"<{kind}>") == 1


def test_clean_text_is_left_alone():
    for text in ("", "plain words.", "in 2024 there were 12,345 of 3.5 and 2020-01-02", "key ca6f2adb7b9e012196032067fe2 x", "1234567890123456", "a@ b @c", "5 10 15 20 25 30"):
        assert pii.find(text, pii.trained())[1] == [] and (text.startswith("12345") or pii.redact(text, pii.trained()) == text)


@pytest.mark.parametrize(
    "text,kind,value",
    [
        ("call 020 7946 0958 now", "phone", "020 7946 0958"), ("tel 0171/2345678 or", "phone", "0171/2345678"), ("phone 614.5558001 please", "phone", "614.5558001"),
        ("the number is 555-0142 there", "phone", "555-0142"), ("card 3782.822463.10005 was", "card", "3782.822463.10005"), ("fax 01 42 68 53 00 today", "phone", "01 42 68 53 00"),
    ],
)
def test_the_model_adds_spans_of_other_shapes(text, kind, value):
    at = text.index(value)
    assert pii.find(text, pii.trained())[1] == [(kind, at, at + len(value))]
    assert pii.redact(text, pii.trained()) == text.replace(value, f"<{kind}>")


def test_numbers_of_other_kinds_are_left_alone():
    for text in ("from 1999-2004 on", "on 12/05/2020 and 2020/11/03", "a ratio of 51.5074 to 0.1278", "rows 1000 2000 3000 were read", "sum 1,234,567.89 in all", "at 10:20:30 on 2021-03-04", "see 978-3-16-148410-0 there", "card 3782.822463.10006 was", "pages 120-135"):
        assert pii.find(text, pii.trained())[1] == [], text


def test_odd_rows_are_searched(spark, odd, none):
    rows = pii.spans(odd).collect()
    assert len(rows) == odd.count() and {s.kind for r in rows for s in r.found if s.base} == set(pii.KINDS)
    out = pii.redacted(odd)
    assert out.columns == odd.columns and out.where("text IS NULL").count() == 2
    assert out.where("text LIKE '%<email>%<phone>%<ip>%<card>%'").count() == 1
    assert pii.spans(none).count() == 0 and pii.redacted(none).count() == 0


def test_no_bound_cuts_an_entity(spark):
    run = "q" * 60 + ".long.name"
    labels = " [dot] ".join(f"label{chr(97 + k)}" for k in range(14))
    for value in (f"{run} [at] mail [dot] org", "a.b.c.d.e.f.g.h.i.j [at] mail [dot] sub [dot] org", f"me [at] {labels} [dot] com"):
        text = f"Please write {value} today."
        assert pii.redact(text, pii.trained()) == "Please write <email> today."


@pytest.mark.parametrize("text,value", [("tel 030 1234567", "030 1234567"), ("Tel. 0171/2345678 x", "0171/2345678"), ("call 00 49 30 1234567 now", "00 49 30 1234567")])
def test_national_numbers(text, value):
    assert pii.redact(text, pii.trained()) == text.replace(value, "<phone>")


@pytest.mark.parametrize("text", ["in version 123.456.7890 it", "the order 1234 5678 9012 3456 came", "on 2021-03-04 at 12:30 there were 1,234,567 people"])
def test_numbers_of_another_sort(text):
    assert pii.redact(text, pii.trained()) == text


def test_unseen_sentences():
    for kind, (recall, precision) in pii.measured().items():
        assert recall >= 0.9 and precision >= 0.9, kind


def test_decoding_is_the_best_of_all_segmentations():
    """Every way to choose candidates that do not overlap, tried one by one."""
    weights = pii.trained()
    for text, _ in pii._examples(60, 77):
        text = text[:60]
        tokens = pii.tokens_of(text, 0, len(text))
        own = [(i, j, k, sum(weights[k].get(x, 0.0) for x in names)) for i, j, k, names in pii._lattice(text, tokens)]
        own = [c for c in own if c[3] > 0]
        best = {len(tokens): 0.0}

        def most(at):
            if at not in best:
                best[at] = max([most(at + 1), *(c[3] + most(c[1]) for c in own if c[0] == at)])
            return best[at]

        found = {(tokens[i][0], tokens[j - 1][1], k): v for i, j, k, v in own}
        got = pii.decode(text, 0, len(text), weights)
        if all((a, b, k) in found for k, a, b in got):  # none went on over more labels
            assert sum(found[a, b, k] for k, a, b in got) == pytest.approx(most(0))


# Top-k


def brute_top(ids, vectors, k, every):
    whole = np.floor(256 * vectors.astype(np.float64))
    out = set()
    for i in np.flatnonzero(ids % every == 0):
        scores = whole @ whole[i]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
        out |= {(int(ids[i]), r + 1, int(ids[j]), int(scores[j])) for r, j in enumerate(order)}
    return out


def test_op7_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    got = {tuple(r) for r in contract.op7_topk(spark, sf_dir).collect()}
    assert got == brute_top(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float32), 5, 50)


def test_top_k_over_blocks_ties_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(0, 0.3, (400, 8)).astype(np.float32)
    vectors[100:200] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    extra = [(1000, None), (1050, [None] * 8), (1100, [float("nan")] * 8), (1150, [float("inf")] * 8), (1200, [1.0]), (1250, []), (None, [9.0] * 8)]
    df = spark.createDataFrame(rows + extra, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash"))
    got = {tuple(r) for r in topk.top_k(df, 5, 10, candidates=64, queries=8).collect()}
    padded = np.concatenate([vectors, [[1.0] + [0.0] * 7, [0.0] * 8]])
    assert got == brute_top(np.concatenate([np.arange(400), [1200, 1250]]), padded, 5, 10)
    assert topk.top_k(df.where("vec_id IN (0, 1, 2)"), 5, 50).count() == 2
    assert topk.top_k(df.where("false")).count() == 0


def test_cover_tree_covers():
    points = np.random.default_rng(1).normal(size=(700, 4))
    tree = topk.CoverTree(points, leaf=5)
    for k in range(len(tree.start)):
        own = points[tree.rows(k)]
        assert np.sqrt(((own - tree.centre[k]) ** 2).sum(1)).max() <= tree.radius[k] + 1e-9
        if not tree.is_leaf(k):
            kids = range(tree.first[k], tree.last[k])
            assert sum(tree.end[c] - tree.start[c] for c in kids) == len(own)
            assert any((tree.centre[c] == tree.centre[k]).all() for c in kids)
            assert all(tree.radius[c] <= topk.SHRINK * tree.radius[k] + 1e-9 for c in kids)
            centres = tree.centre[list(kids)]
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(-1)) + np.eye(len(centres)) * 1e9
            assert apart.min() > topk.SHRINK * tree.radius[k]


def test_tight_clusters_leave_most_pairs_out():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(200, 64))
    centres *= 256 / np.sqrt((centres**2).sum(1, keepdims=True))
    points = np.floor(centres[rng.integers(0, 200, 8000)] + rng.normal(0, 2, (8000, 64)))
    asks = np.arange(0, 8000, 50)
    best = topk.search(topk.CoverTree(points[asks], topk.QUERY_LEAF), asks, topk.CoverTree(points), np.arange(8000), 5)
    products = points[asks] @ points.T
    products[np.arange(len(asks)), asks] = -np.inf
    for k in range(len(asks)):
        assert best.ids[k].tolist() == np.lexsort((np.arange(8000), -products[k]))[:5].tolist()
    print("scored", best.scored / products.size)
    assert best.scored < 0.1 * products.size


def test_blocks_out_of_reach_are_not_visited(spark):
    rng = np.random.default_rng(8)
    centres = np.eye(8) * 100
    rows = [(i, (centres[i % 8] + rng.normal(0, 0.5, 8)).tolist()) for i in range(4000)] + [(9000 + i, [0.0, 100.0] + [0.0] * 6) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in topk.top_k(df, 5, 100, candidates=300, queries=4).collect()}
    assert got == brute_top(np.array([i for i, _ in rows]), np.array([v for _, v in rows]), 5, 100)


# Shards


def brute_shard(key, shards, first):
    """The descent, draw by draw, over the shards' regions and racks."""
    wide = next(w for w in range(1, 100) if w**3 >= first)
    runs = lambda xs, n: [xs[k * len(xs) // n : (k + 1) * len(xs) // n] for k in range(n)]
    regions = [runs(own, min(wide, len(own))) for own in runs(list(range(first)), min(wide, first))] + [[[i]] for i in range(first, shards)]
    least = lambda names: min(names, key=lambda nw: -math.log((int(hashlib.md5(f"{key}:{nw[0]}".encode()).hexdigest()[:13], 16) + 1) / 2**52) / nw[1])
    r = least([(f"region-{k}", sum(map(len, racks)), k) for k, racks in enumerate(regions)])[2]
    c = least([(f"region-{r}/rack-{k}", len(own), k) for k, own in enumerate(regions[r])])[2]
    return least([(f"shard-{i}", 1, i) for i in regions[r][c]])[2]


@pytest.mark.parametrize("shards,first", [(8, 8), (9, 8), (27, 27), (100, 100), (103, 100), (5, 5), (1, 1)])
def test_shards_are_those_of_the_draws(spark, shards, first):
    rows = spark.range(300).select("id", sharding.shard_column(F.col("id"), sharding.topology(shards, first=first)).alias("s")).collect()
    assert all(r.s == brute_shard(r.id, shards, first) for r in rows)


def test_op8_draws(spark, sf_dir):
    rows = contract.op8_sharding(spark, sf_dir).collect()
    assert all((r.shard, r.grown_shard) == (brute_shard(r.doc_id, 8, 8), brute_shard(r.doc_id, 9, 8)) for r in rows)


def test_one_repeated_row_is_dealt_whole(spark):
    df = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))
    rows = sharding.deal(df, 8).collect()
    assert len({r.shard for r in rows}) == 1 and sorted(r.slot for r in rows) == list(range(3000))
    found = simhash.near_duplicates(df).collect()
    assert len(found) == 3000 and {r.component_id for r in found} == {7}


def test_op8_keeps_its_law(spark, sf_dir, docs):
    rows = contract.op8_sharding(spark, sf_dir).collect()
    texts = dict(docs)
    slots = {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 8
    assert sum(r.grown_shard == 8 for r in rows) > 0


def test_shards_of_many_keys(spark):
    keys = spark.range(40000).select(F.col("id"), *(sharding.shard_column(F.col("id"), sharding.topology(n, first=8)).alias(f"s{n}") for n in (8, 9, 10)))
    moved = keys.agg(*(F.count_if((F.col(f"s{a}") != F.col(f"s{b}")) & (F.col(f"s{b}") != a)).alias(f"m{a}") for a, b in ((8, 9), (9, 10)))).first()
    assert tuple(moved) == (0, 0)
    for n in (8, 10):
        counts = [r["count"] for r in keys.groupBy(f"s{n}").count().collect()]
        assert len(counts) == n and max(counts) < 1.15 * 40000 / n and min(counts) > 0.85 * 40000 / n


def test_a_changed_weight_moves_keys_by_its_subtree_only(spark):
    before, after = sharding.topology(8), sharding.topology(8, [1, 1, 1, 1, 1, 1, 1, 3])
    k = F.col("id")
    rows = spark.range(20000).select(sharding.shard_column(k, before).alias("a"), sharding.shard_column(k, after).alias("b")).where("a <> b").groupBy("a", "b").count().collect()
    assert rows and all(r.b >= 4 for r in rows)  # only into the region whose weight grew
    assert all(r.b >= 6 for r in rows if r.a in (4, 5)) and all(r.b == 7 for r in rows if r.a == 6)
    assert sharding.topology(8, [1, 1, 1, 1, 0, 0, 0, 0]).weight == 4


def test_shards_of_odd_rows(spark, odd, none):
    rows = sharding.deal(odd, 8).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.deal(none, 8).count() == 0


# Near copies


def brute_components(rows, distance=3):
    """rows: (id, fingerprint)."""
    ids = [i for i, _ in rows]
    fps = np.array([f for _, f in rows], np.uint64)
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps[k + 1 :] ^ fps[k]) <= distance) + k + 1:
            root[find(int(j))] = find(k)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: least[find(k)] for k, i in enumerate(ids)}


def brute_fingerprint(text):
    from xxhash import xxh64

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op9_equals_brute_force(spark, sf_dir, docs):
    want = {i: brute_fingerprint(t) for i, t in docs}
    groups = brute_components(sorted(want.items()))
    rows = contract.op9_simhash(spark, sf_dir).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{f:016x}" for i, f in want.items()}
    assert {r.doc_id: r.component_id for r in rows} == groups


def test_links_lose_nothing(spark):
    rng = np.random.default_rng(5)
    fps = set(rng.integers(0, 2**63, 500, dtype=np.uint64).tolist())
    for centre in rng.integers(0, 2**63, 30, dtype=np.uint64).tolist():
        for _ in range(20):
            x = centre
            for b in rng.choice(64, rng.integers(0, 6), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    base = int(rng.integers(0, 2**63, dtype=np.uint64)) & ~0x1FFF
    fps |= {base | int(x) for x in rng.choice(2**13, 2600, replace=False)}  # a half that too many share
    rows = [(k, f) for k, f in enumerate(sorted(fps))]
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for _, f in rows], "fp long")
    found = {r.u: r.root for r in components(simhash.links(simhash.written(df))).collect()}
    place = {int(np.uint64(f).view(np.int64)): k for k, f in rows}
    want = brute_components(rows)
    groups = {}
    for f, k in place.items():
        groups.setdefault(found.get(f, f), set()).add(want[k])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))
    with pytest.raises(ValueError):
        simhash.links(df, 4)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(7, 7), (500, 400), (400, 500)], "a long, b long")
    assert {(r.u, r.root) for r in components(edges).collect()} == {(k, 0) for k in range(1, 301)} | {(500, 400)}
    assert components(edges.where("false")).count() == 0


def test_near_copies_of_odd_rows(spark, odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    wordless = [r for r in rows if r.fp == 0]
    assert len(wordless) >= 5 and {r.component_id for r in wordless} == {0}
    assert {r.component_id for r in rows if r.doc_id in (13, 14)} == {13}
    assert simhash.near_duplicates(odd.where("doc_id IS NULL")).first().component_id is None
    assert simhash.near_duplicates(none).count() == 0


# Rules


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if seen[tuple(words[k : k + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_op10_equals_brute_force(spark, sf_dir, docs):
    texts = dict(docs)
    rows = contract.op10_rules(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_rules_agree_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = contract.op10_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id").where("NOT base_failed").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.1


@pytest.mark.parametrize(
    "line,fails",
    [
        ("", False), ("A title line", False), ("This sentence is as long as any and ends with a stop.", False), ("this one is as long as any and has no end", True),
        ("Home | News | Sport | About", True), ("All rights reserved.", True), ("A&&& b*** c###.", True), ("WOW!! BUY!! NOW!!", True), ("He asked: why?", False),
    ],
)
def test_lines(spark, line, fails):
    assert spark.range(1).select(rules.line_fails(F.lit(line)).alias("f")).first().f is fails


def test_rules_of_odd_rows(spark, odd, none):
    out = rules.judge(odd)
    assert set(odd.columns) - set(rules.RESULTS) <= set(out.columns) and out.count() == odd.count()
    for r in out.select(*[c for c in out.columns]).join(odd.select("doc_id", F.col("text").alias("t2")), "doc_id").where("doc_id <> 14").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(r.t2)
    kept = rules.clean(odd)
    assert kept.columns == odd.columns and kept.where("NOT kept").count() == 0
    assert rules.judge(none).count() == 0 and rules.clean(none).count() == 0


def test_cleaning_removes_lines(spark):
    text = "The first of these sentences has more than enough words to stay.\nHome | News | Sport\nNor will any rule take away this last and longer one, of course."
    df = spark.createDataFrame([(1, text), (2, "Home | News | Sport | More | Less | About\n" * 2 + "Only these few.")], "doc_id long, text string")
    (row,) = rules.clean(df).collect()
    assert row.text.split("\n") == text.split("\n")[::2]


# Samples of the classifier


def test_scores_are_those_of_the_sample_by_hand(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = quality._hashed(docs).collect()
    unseen = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0
    seen = sorted({r.h: (r.doc_id, r.text) for r in rows if not unseen(r.doc_id)}.items())
    x = np.array([quality.measure(t or "") for _, (_, t) in seen], np.float64)
    good = [k for k, (_, (i, _)) in enumerate(seen) if labels.get(i) == 1]
    net = quality.train(x[good], x, quality.class_prior(x[good], x))
    want = {r.doc_id: net.score(np.array([quality.measure(r.text or "")], np.float64))[0] for r in rows}
    for r in contract.op4_quality(spark, sf_dir).collect():
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-6) and r.held_out == unseen(r.doc_id) and r.predicted == (r.score >= 0.3)


@pytest.mark.parametrize("ids", ["NULL", "7", "id", "id % 3"])
def test_samples_are_never_empty_and_keep_their_bound(spark, ids):
    df = spark.range(20_000).select(F.expr(f"cast({ids} AS bigint)").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    rows = quality._hashed(df)
    assert 0 < len(quality._matrix(quality._sampled(rows, 10), 10)) <= 10
    same = df.withColumn("text", F.lit("one text"))
    assert 0 < len(quality._matrix(quality._sampled(quality._hashed(same), 10), 10)) <= 10
    assert len(quality._matrix(quality._sampled(rows, 30_000), 30_000)) == 20_000


# Pipeline


def test_pipeline_stages(spark, sf_dir, docs):
    import corpus_pipeline as cp

    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    now, before = table, None
    for name, stage in cp.STAGES[:-1]:
        before, now = now, simhash.written(stage(spark, now, sf_dir))
        assert now.columns == table.columns
        old, new = ({r.doc_id: r.text for r in df.collect()} for df in (before, now))
        assert set(new) <= set(old)
        if name == "quality classifier":
            predicted = {r.doc_id for r in contract.op4_quality(spark, sf_dir).collect() if r.predicted}
            assert set(new) == predicted and all(new[i] == old[i] for i in new)
        if name == "quality rules":
            assert set(new) == {r.doc_id for r in rules.judge(before).where("kept").collect()}
        if name == "near duplicates":
            least = [min(i for i, t in old.items() if t in g) for g in brute_similar(sorted(set(old.values())))]
            assert set(new) == set(least)
        if name == "personal data":
            assert set(new) == set(old) and all(new[i] == pii.redact(old[i], pii.trained()) for i in old)
            assert all(r.n_chars == len(r.text) for r in now.collect())
    packed = cp.run(spark, sf_dir).collect()
    assert {r.doc_id for r in packed} == set(new)


def test_pipeline_of_odd_rows(spark, odd, none, tmp_path):
    import corpus_pipeline as cp

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for k, df in enumerate((odd.select(*columns, "kept"), none.select(*columns))):
        sf = str(tmp_path / str(k))
        df.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(4, 1), (14, 1)], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
        assert cp.run(spark, sf).columns[0] == "doc_id"


# Similar texts


def brute_similar(texts):
    """Groups of the distinct texts by shingles of five words, every pair compared."""
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(texts)))
    for k, own in enumerate(sets):
        for j in range(k):
            if 5 * len(own & sets[j]) >= 4 * len(own | sets[j]) and root[k] != root[j]:
                root = [root[j] if r == root[k] else r for r in root]
    return {frozenset(texts[k] for k in range(len(texts)) if root[k] == r) for r in set(root)}


def near_texts():
    """Texts around similarity 0.8, among them a group wide enough to need both rounds."""
    rng = np.random.default_rng(3)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 4000, n)]
    out = ["", " ", "one two", "One  two", "one two three"]
    for many, size in ((60, 60), *((4, n) for n in (5, 8, 20, 45, 90, 300))):
        stem = words(size)
        for _ in range(many):
            copy = list(stem)
            for at in rng.choice(size, rng.integers(0, max(2, size // 25)), replace=False):
                copy[at] = f"n{rng.integers(0, 10**6)}"
            out.append(" ".join(copy + words(rng.integers(0, 4))))
    return sorted(set(out + [" ".join(words(30)) for _ in range(40)]))


@pytest.mark.parametrize(("most", "common"), [(2048, 256), (6, 256), (6, 1 << 30)])
def test_similar_groups_equal_brute_force(spark, monkeypatch, most, common):
    from tessera.llm import similar

    monkeypatch.setattr(similar, "MOST", most)  # 6: most groups are dealt to several blocks
    monkeypatch.setattr(similar, "COMMON", common)  # 1 << 30: all shingles that repeat are common
    texts = near_texts()
    df = similar.written(spark.createDataFrame([(t,) for t in texts], "text string").select(similar.node_of(F.col("text")).alias("node"), "text"))
    nodes, root = {r.node: r.text for r in df.collect()}, {r.node: r.root for r in similar.groups(df).collect()}
    got = {}
    for n, t in nodes.items():
        got.setdefault(root.get(n, n), set()).add(t)
    assert {frozenset(g) for g in got.values()} == brute_similar(texts)


def test_parity_bounds_differences():
    from tessera.llm import similar

    rng = np.random.default_rng(9)
    for size in (1, 50, 1000, 1500, 5000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(size * 0.9)], rng.integers(0, 2**63, size // 12).astype(np.uint64)]))
        block = similar._Block(np.arange(2), np.array([len(a), len(b)]), [similar.parity(a), similar.parity(b)], np.arange(2))
        found = len(block.near(0, block, np.array([1])))
        assert found >= similar.similar(a, b)
        apart = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        other = similar._Block(np.arange(2), np.array([len(a), len(apart)]), [similar.parity(a), similar.parity(apart)], np.arange(2))
        assert not len(other.near(0, other, np.array([1])))


def test_pipeline_keeps_one_of_each_similar_group(spark, sf_dir):
    import corpus_pipeline as cp

    texts = near_texts()
    df = simhash.written(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    want = {min(texts.index(t) for t in g) for g in brute_similar(texts)}
    assert {r.doc_id for r in cp.near_duplicates(spark, df, sf_dir).collect()} == want
    assert cp.near_duplicates(spark, df.where("false"), sf_dir).count() == 0


def test_rows_that_share_an_id_or_have_none_are_not_one_document(spark, sf_dir):
    import corpus_pipeline as cp

    rng = np.random.default_rng(4)
    a, b, c, d, e = (" ".join(f"w{x}" for x in rng.integers(0, 9999, 60)) for _ in range(5))
    rows = [(None, a, 1), (None, b, 1), (None, c, 2), (None, c, 1), (7, d, 1), (8, d + " end", 1), (8, e, 1), (8, e, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = Counter(tuple(r) for r in cp.near_duplicates(spark, df, sf_dir).collect())
    assert got == Counter([(None, a, 1), (None, b, 1), (None, c, 1), (7, d, 1), (8, e, 1)])
