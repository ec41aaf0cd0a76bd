"""BPE, token files and prefix counts against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from reviewflow.llm import bpe, token_counts, token_files

DOCS = "doc_id long, text string, ids string"


def test_encoder_matches_library(library, tokenizer_file, hard_texts):
    enc = bpe.Encoder(bpe.vocabulary(tokenizer_file))
    want = [e.ids for e in library.encode_batch(hard_texts, add_special_tokens=False)]
    for _ in range(2):  # cold and warm caches
        got = enc.encode(hard_texts)
        assert [g.tolist() for g in got] == want
    assert [enc.decode(g) for g in got] == [library.decode(w, skip_special_tokens=False) for w in want]


def test_small_caches_change_nothing(library, tokenizer_file, hard_texts):
    enc = bpe.Encoder(bpe.vocabulary(tokenizer_file))
    for cache in (enc.pieces, enc.units, enc.leading):
        cache.size = 3
    for k in range(0, len(hard_texts), 7):
        part = hard_texts[k:k + 7]
        assert [g.tolist() for g in enc.encode(part)] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


def test_prefix_counts_match_library_at_every_cut(library, tokenizer_file, hard_texts):
    count = token_counts.PrefixCounter(bpe.vocabulary(tokenizer_file))
    texts = [t[:60] for t in hard_texts[:150] + hard_texts[-9:]]
    for t, got in zip(texts, count.counts(texts)):
        want = [len(e.ids) for e in library.encode_batch([t[:i] for i in range(len(t) + 1)], add_special_tokens=False)]
        assert got.tolist() == want
        assert token_counts.unpacked(token_counts.packed(got)).tolist() == want


def test_units_at_white_space_match_library(library, tokenizer_file):
    """Random texts of letters, marks and every kind of white space: units that begin or end with white space,
    empty units, texts without units, contractions and added tokens among them."""
    signs = [" ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "a", "Zé", "中", "\u0301", "1", "Ⅷ",
             ".", ",", "'s", "'re", "'", "😀", "<|endoftext|>", "the"]
    draw = random.Random(5)
    texts = ["", " ", "  ", "a ", "a\n \nfoo", *("".join(draw.choices(signs, k=draw.randrange(12))) for _ in range(4000))]
    enc = bpe.Encoder(bpe.vocabulary(tokenizer_file))
    for k in range(0, len(texts), 900):
        part = texts[k:k + 900]
        assert [g.tolist() for g in enc.encode(part)] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


@pytest.fixture(scope="module")
def docs(spark, hard_texts):
    rows = [(k, t, "clash") for k, t in enumerate(hard_texts[-40:])] + [(900, None, None), (None, "no id", None), (901, "twice", None), (901, "twice", None)]
    return spark.createDataFrame(rows, DOCS)


def test_encode_decode_frames(docs, library, tokenizer_file):
    assert bpe.encode(docs, tokenizer_file).columns == [*docs.columns, "_ids"]  # a column named ids is there
    rows = bpe.decode(bpe.encode(docs, tokenizer_file, into="tokens"), tokenizer_file, ids="tokens").collect()
    assert len(rows) == docs.count() and {"ids", "tokens", "decoded"} < set(rows[0].asDict())
    for r in rows:
        assert r.tokens == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")


def test_round_trip_equals_encode_and_decode(docs, tokenizer_file):
    two = bpe.decode(bpe.encode(docs, tokenizer_file, into="tokens"), tokenizer_file, ids="tokens")
    one = bpe.round_trip(docs, tokenizer_file, ids="tokens")
    assert one.columns == two.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_empty_tables(spark, tokenizer_file):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(none, tokenizer_file).count() == 0
    assert token_counts.prefix_counts(none, tokenizer_file).count() == 0
    assert token_files.read(token_files.write(none, tokenizer_file)).count() == 0


def test_longest_prefix(docs, library, tokenizer_file):
    rows = token_counts.longest_prefix(token_counts.prefix_counts(docs, tokenizer_file), 5).collect()
    for r in rows:
        t = r.text or ""
        assert r.n_bytes == len(t.encode()) and r.n_tokens == len(library.encode(t, add_special_tokens=False).ids)
        if len(t) < 100:
            fits = [i for i in range(len(t) + 1) if len(library.encode(t[:i], add_special_tokens=False).ids) <= 5]
            assert r.chars_within == fits[-1]


def reference_files(docs, library):
    rows = [(r.doc_id, np.array(library.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")) for r in docs.collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for d, ids in rows:
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("files, frame_tokens", [(1, 1 << 20), (5, 16)])
def test_token_files(docs, library, tokenizer_file, files, frame_tokens):
    manifest = token_files.write(docs, tokenizer_file, files=files, frame_tokens=frame_tokens)
    got = sorted(map(tuple, token_files.read(manifest).collect()), key=lambda r: r[1])
    assert got == reference_files(docs, library)
    some = token_files.read(manifest, only=[3, 901, None]).collect()
    assert sorted(map(tuple, some), key=lambda r: r[1]) == [r for r in got if r[0] in (3, 901, None)]


def test_damaged_frame_is_found(spark, tokenizer_file, tmp_path):
    docs = spark.createDataFrame([(1, "some words of a text")], "doc_id long, text string")
    manifest = token_files.write(docs, tokenizer_file, folder=f"file://{tmp_path}/files", files=1)
    path = manifest.first().path.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[8] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception):
        token_files.read(manifest).collect()


def test_registered_queries(spark, library):
    from reviewflow.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in QUERIES["op1_bpe_encode_decode"](spark, d).collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    counts = {r.doc_id: r for r in QUERIES["op8_token_counts"](spark, d).collect()}
    assert {k: (c.n_bytes, c.n_tokens, c.over_limit) for k, c in counts.items()} == {
        k: (len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 512) for k, t in docs.items()}
    got = QUERIES["op5_token_files"](spark, d).orderBy("start").collect()
    assert [tuple(r) for r in got] == reference_files(spark.read.parquet(f"{d}/documents.parquet"), library)
