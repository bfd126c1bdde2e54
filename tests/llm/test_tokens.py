"""Encoding, packing and Huffman files against the libraries and exact round trips."""

import hashlib
import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F

from tessera.llm import contract, huffman, packing
from tessera.llm import sentencepiece as sp
from tessera.llm.bpe import Bpe

os.environ["TOKENIZERS_PARALLELISM"] = "false"
MODEL = path("piece_bpe_32k.model")
crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1_equals_the_library(spark, sf_dir, docs):
    own = sp.encoder(MODEL).whole
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in contract.op1_sentencepiece(spark, sf_dir).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, t in docs:
        ids = own.encode(t or "")
        assert got[i] == (len(ids), sha(",".join(map(str, ids))), sha(own.decode(ids)))


def test_spans_equal_the_library(docs):
    own = sp.encoder(MODEL)
    texts = [t or "" for _, t in docs[:40]] + ["", " ", "  a  b ", "日本 😀é", "▁x", "a" * 3000, "\x00b", "<s> </s>"]
    for t, (ids, begins, ends) in zip(texts, own.encode(texts), strict=True):
        want = own.whole.encode(t, return_type="proto").pieces
        assert [(p.id, p.begin, p.end) for p in want] == list(zip(ids.tolist(), begins.tolist(), ends.tolist(), strict=True))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf", "identity"])
def test_character_map_equals_the_library(rule, docs):
    from sentencepiece import SentencePieceNormalizer, sentencepiece_model_pb2

    lib = SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, remove_extra_whitespaces=True, escape_whitespaces=True)
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(lib.serialized_model_proto())
    own = sp.Normaliser(model.normalizer_spec, [], False)
    for t in [t or "" for _, t in docs[:20]] + ["ﬁ Ⅷ ｶﾞ é Å", "  two  spaces ", "　wide", "A​B", "㍿", ""]:
        got, at = own(t.encode())
        want, offsets = lib.normalize(t, with_offsets=True)
        assert got.decode() == want
        places = np.concatenate([[0], np.cumsum([len(c.encode()) for c in want])]).astype(int)
        assert [len(t.encode()[: at[p]].decode()) for p in places] == list(offsets)


def test_op1_of_odd_rows(spark, odd, none):
    rows = sp.encode(odd, MODEL, decoded=True).collect()
    assert len(rows) == odd.count()
    assert all(r.decoded == "" and r.ids == [] for r in rows if r.id is None)
    assert sorted(len(r.ids) for r in rows)[-1] > 9000
    again = {r.id: r.decoded for r in sp.decode(sp.encode(odd, MODEL).where("id IS NOT NULL"), MODEL).collect()}
    assert again == {r.id: r.decoded for r in rows if r.id is not None}
    assert sp.encode(none, MODEL).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_quick_encoding_equals_the_library(name, docs):
    own = Bpe(path(name))
    assert own.ranks is not None or own.marked is not None
    rnd = random.Random(3)
    letters = list("aAbt .,'sS\n\t\x0b\x1c\x85\xa0 éÀßΣς́ İKﬁ日!?12²½ª\x00")
    texts = [t or "" for _, t in docs] + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(3000)] + ["<|endoftext|>", "x" * 5000, " " * 3000]
    want = [e.ids for e in own.library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.encode(texts)] == want


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_equal_the_untouched_library(name):
    import json

    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(path(name)), Bpe(path(name))
    with open(path(name), encoding="utf-8") as f:
        marks = [t["content"] for t in json.load(f)["added_tokens"]]
    texts = [t for m in marks for t in (m, f"x {m} y", f"X{m}{m} é\n", f"日 {m.upper()} {m[:-1]}", f"{m.upper()} a", f"a {m.title()}b")] + ["plain <| text |>"]
    got = [x.tolist() for x in own.encode(texts)]
    assert marks and got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert any(library.token_to_id(m) in ids for m in marks for ids in got)


def check_packing(rows, texts, capacity=2048):
    own = Bpe(path("byte_bpe_50k.json"))
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    total = 0
    for doc, text in texts.items():
        ids = [*own.encode([text or ""])[0].tolist(), 0]
        total += len(ids)
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        want = [(k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc]) == want
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq), -(-total // capacity)


def test_op2_packs_every_piece(spark, sf_dir, docs):
    used, least = check_packing(contract.op2_packing(spark, sf_dir).collect(), dict(docs))
    assert used <= least * 1.05 + 1


def test_packing_of_odd_rows(spark, odd, none):
    rows = packing.pack(odd.where("doc_id IS NOT NULL AND doc_id <> 14"), path("byte_bpe_50k.json")).collect()
    check_packing(rows, {r.doc_id: r.text for r in odd.where("doc_id IS NOT NULL AND doc_id <> 14").collect()})
    rows = packing.pack(odd, path("byte_bpe_50k.json")).collect()
    assert sum(r.piece == 0 for r in rows) == odd.count()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.pack(none, path("byte_bpe_50k.json")).count() == 0


@settings(deadline=None, max_examples=40)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 60), max_size=20))
def test_plans_use_each_document_once(sizes):
    counts = np.zeros(65, np.int64)
    for size, n in sizes.items():
        counts[size] = n
    used = np.zeros(65, np.int64)
    plan = packing.plan(counts, 64)
    for lengths, n in plan:
        assert sum(lengths) <= 64 and n > 0
        for size in lengths:
            used[size] += n
    assert (used == counts).all()
    assert sum(n for _, n in plan) <= max(1, 2 * -(-int((np.arange(65) * counts).sum()) // 64))


def test_fit_finds_an_exact_mixture():
    counts = np.zeros(65, np.int64)
    for lengths, n in (((20, 44), 300), ((10, 24, 30), 200), ((64,), 50)):
        for size in lengths:
            counts[size] += n
    columns = packing.patterns(np.flatnonzero(counts), 64)
    x = packing.fit(columns, counts)
    assert {tuple(v for v in c if v): round(n) for c, n in zip(columns.tolist(), x, strict=True) if n > 0.5} == {(20, 44): 300, (10, 24, 30): 200, (64,): 50}
    assert sum(n for _, n in packing.plan(counts, 64)) == 550


def test_op3_reads_back_what_it_wrote(spark, sf_dir, docs):
    own = Bpe(path("word_bpe_49k.json"))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in contract.op3_huffman(spark, sf_dir).collect()}
    at = 0
    for i, t in sorted(docs):
        ids = [*own.encode([t or ""])[0].tolist(), 1]
        assert got[i] == (at, len(ids), crc(ids))
        at += len(ids)


def test_huffman_of_odd_rows(spark, odd, none, monkeypatch):
    monkeypatch.setattr(huffman, "FILE_IDS", 1000)
    back = huffman.with_starts(huffman.round_trip(odd, path("word_bpe_49k.json"))).collect()
    assert len(back) == odd.count() and len({r.file for r in back}) > 1
    own, at = Bpe(path("word_bpe_49k.json")), 0
    want = sorted((r.doc_id is not None, r.doc_id or 0, crc([*own.encode([r.text or ""])[0].tolist(), 1])) for r in odd.collect())
    for r, (known, doc, code) in zip(sorted(back, key=lambda r: r.start), want, strict=True):
        assert (r.doc_id is not None, r.doc_id or 0, zlib.crc32(r.ids), r.start) == (known, doc, code, at)
        at += r.n_tokens
    assert huffman.round_trip(none, path("word_bpe_49k.json")).count() == 0


@settings(deadline=None, max_examples=50)
@given(st.lists(st.lists(st.integers(0, 300), max_size=600), min_size=1, max_size=6))
def test_blocks_round_trip(texts):
    counts = np.bincount([x for t in texts for x in t] or [0], minlength=301)
    lengths = huffman.code_lengths(counts)
    used = lengths[lengths > 0].astype(float)
    assert len(used) < 2 or (2.0**-used).sum() == 1
    book = huffman.Codebook(lengths)
    bits, marks = zip(*(book.encode(np.array(t, np.int64)) for t in texts), strict=True)
    data = huffman.pack_block(list(range(len(texts))), [len(t) for t in texts], list(marks), list(bits))
    ((docs, ids),) = huffman.read_blocks(data, book)
    assert docs == list(range(len(texts))) and [x.tolist() for x in ids] == texts


def test_lengths_are_limited_and_best():
    counts = np.array([2**k for k in range(30)])
    lengths = huffman.code_lengths(counts, 8)
    assert lengths.max() == 8 and (2.0 ** -lengths.astype(float)).sum() == 1
    small = np.array([5, 9, 12, 13, 16, 45])
    assert (huffman.code_lengths(small, 16) * small).sum() == 224  # the textbook's tree


def test_broken_block_is_refused():
    with pytest.raises(ValueError):
        list(huffman.read_blocks(b"nothing of the kind", huffman.Codebook(np.array([1, 1], np.uint8))))


def test_columns_with_other_names(spark):
    df = spark.createDataFrame([(1, "a b c")], "k long, body string").withColumn("ids", F.lit(0))
    assert sp.encode(df, MODEL, "k", "body").first().id == 1
    assert packing.pack(df, path("byte_bpe_50k.json"), id_col="k", text_col="body").first().doc_id == 1


def test_a_dataset_is_read_by_its_folder_alone(spark, tmp_path, docs, monkeypatch):
    df = spark.createDataFrame(docs + [(10**6, "word " * 30000)], "doc_id long, text string")
    monkeypatch.setattr(huffman, "FILE_IDS", 20_000)
    tokens = huffman.written(huffman.tokenise(df, path("word_bpe_49k.json"), 1))
    huffman.write(tokens, str(tmp_path / "ids"), 1 << 16)
    back = {r.doc_id: r for r in huffman.read(spark, str(tmp_path / "ids")).collect()}
    want = {r.doc_id: bytes(r.ids) for r in tokens.collect()}
    assert {i: bytes(np.frombuffer(r.ids, "<u4").astype("<u2").tobytes()) for i, r in back.items()} == want
    sizes = {}
    for r in back.values():
        sizes[r.file] = sizes.get(r.file, 0) + r.n_tokens
    longest = max(r.n_tokens for r in back.values())
    assert len(sizes) > 2 and sorted(sizes.values())[-1] <= longest + 40_000 and all(v <= 60_000 for f, v in sizes.items() if f != back[10**6].file)
