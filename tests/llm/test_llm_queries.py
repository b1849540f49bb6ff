"""The registered queries: against SQL where there is some, else against plain versions."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import brute
import compare
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerspark.llm import byte_bpe, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select doc_id, text, lang from '{SF_DIR}/documents.parquet'").fetchall()


def rows_of(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    result = queries.QUERIES[name](spark, SF_DIR).toArrow()
    assert compare.multiset_diff(compare.connect(SF_DIR), result, queries.ORACLE_SQL[name]) == []


def test_op1(spark, docs):
    plain = brute.repeated_strings([t for _, t, _ in docs])
    expected = {
        i: (n, gone, runs, hashlib.sha256(kept).hexdigest())
        for (i, _, _), (n, gone, runs, kept) in zip(docs, plain, strict=True)
    }
    got = rows_of(spark, "op1_suffix_dedup")
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expected
    assert sum(r.n_removed for r in got) > 0


def test_op4(spark, docs):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    pattern = public_tokenizers.PATTERN
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    expected = {}
    for i, text, _ in docs:
        ids = plain.encode_ordinary(text or "")
        digests = [np.array(ids, "<u4").tobytes(), (text or "").encode()]
        expected[i] = (len(ids), *(hashlib.sha256(x).hexdigest() for x in digests))
    got = rows_of(spark, "op4_byte_bpe")
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == expected


def packed_well(rows, capacity=4096):
    """Sequences are gapless from 0 and within capacity; returns their number."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def pieces_of(text, tokenizer, capacity=4096):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
    for piece, start in enumerate(range(0, len(ids), capacity)):
        cut = np.array(ids[start : start + capacity], "<u4")
        yield piece, start, len(cut), zlib.crc32(cut.tobytes())


def test_op6(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {(i, *p) for i, text, _ in docs for p in pieces_of(text, tokenizer)}
    got = rows_of(spark, "op6_best_fit_packing")
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == expected
    assert packed_well(got) <= -(-sum(p[3] for p in expected) // 4096) + 1


def test_op7(spark, docs):
    expected = brute.near_groups([(i, t) for i, t, _ in docs])
    got = rows_of(spark, "op7_ngram_jaccard")
    assert {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in got} == expected
    assert {r.doc_id for r in got if r.kept} == {g for g, _, _ in expected.values()}


def test_op8(spark, docs):
    """Against the phrases that the test documents use."""
    phrases = {
        "MIT": "MIT License", "Apache-2.0": "Apache License", "GPL": "GNU General Public",
        "CC-BY-NC": "CC BY-NC",
    }
    expected = {i: sorted(f for f, p in phrases.items() if p in (t or "")) for i, t, _ in docs}
    got = rows_of(spark, "op8_licence_scan")
    assert {r.doc_id: r.families for r in got} == expected
    assert sum(r.n_unknown for r in got) == 0


def test_op9(spark, docs):
    langs = {i: lang for i, _, lang in docs}
    got = rows_of(spark, "op9_language_id")
    assert {r.doc_id: r.held_out for r in got} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in langs}
    right = [r.lang_pred == langs[r.doc_id] for r in got if r.held_out]
    assert sum(right) / len(right) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_pipeline(spark, docs):
    """Every stage after the first against a plain version on what the first keeps."""
    known = corpus_pipeline.known_language(
        spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR
    )
    left = sorted((r.doc_id, r.text) for r in known.collect())
    assert len(left) >= 0.9 * len(docs)
    stays = brute.exact_groups(left)
    left = [(i, t) for i, t in left if stays[i][0] == i]
    groups = brute.near_groups(left)
    left = [(i, t) for i, t in left if groups[i][0] == i]
    cut = brute.repeated_strings([t for _, t in left])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {
        (i, *piece)
        for (i, _), (*_, kept) in zip(left, cut, strict=True)
        for piece in pieces_of(kept.decode(errors="ignore"), tokenizer)
    }
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == expected
    packed_well(got)


def test_op11(spark):
    vectors = duckdb.sql(f"select vec_id, embedding from '{SF_DIR}/embeddings.parquet'").fetchall()
    ids = np.array([i for i, _ in vectors])
    data = np.array([v for _, v in vectors], "f4").astype("f8")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in rows_of(spark, "op11_permutation_index")}
    expected = {}
    for q in np.flatnonzero(ids % 20 == 0):
        scores = (data * data[q]).sum(axis=1)
        scores[q] = -np.inf
        for rank, at in enumerate(np.lexsort((ids, -scores))[:20], 1):
            expected[int(ids[q]), rank] = (int(ids[at]), float(scores[at]))
    assert got.keys() == expected.keys()
    found = {(q, i) for (q, _), (i, _) in got.items()}
    true = {(q, i) for (q, _), (i, _) in expected.items()}
    assert len(found & true) >= 0.95 * len(true)
