import base64
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from ratingstream.llm import byte_bpe as B
from ratingstream.llm import packing as K
from llm_fixtures import no_docs, odd_docs  # noqa: F401

ODD = ["", "a", " ", "  x", "<|endoftext|> it's\r\n\n  ok", "é́ à🏳️‍🌈 日本語 ܐ𐍈", "a  b", "a\n b", "x \n y", "a\u00a0 b\u3000\n\nc", "a\x1c b \x1f\x1f c", "tail ", " head", "Σας ΣΑΣ İstanbul J̌ 12½"]


def odd_texts():
    rnd = random.Random(5)
    kinds = [lambda: rnd.randrange(32, 127), lambda: rnd.choice([32, 9, 10, 0x2003, 0xA0, 0x85]), lambda: rnd.randrange(0xA0, 0x3000), lambda: rnd.randrange(0x10000, 0x1FFFF)]
    return ODD + ["".join(chr(rnd.choice(kinds)()) for _ in range(40)) for _ in range(400)]


@pytest.fixture(scope="module")
def tik():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_ids_equal_tiktokens_and_decode_back(tik):
    path = P.path(B.VOCABULARY)
    table, split = B._tokenizer(path), regex.compile(P.PATTERN).findall
    for t in odd_texts():
        ids, sizes = table.ids([B.units(t, split)])
        assert ids.tolist() == tik.encode_ordinary(t)
        data, n = B.decode_ids(ids, sizes, path)
        assert data.tobytes() == t.encode()


def test_every_character_beside_letters_and_blanks(tik):
    table, split = B._tokenizer(P.path(B.VOCABULARY)), regex.compile(P.PATTERN).findall
    own = K.WordIds(P.path(K.VOCABULARY))
    whole = Tokenizer.from_file(P.path(K.VOCABULARY))
    whole.encode_special_tokens = True
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(chars), 800):
        t = "".join(f"a{c}b {c}{c}1" for c in chars[i : i + 800])
        assert table.ids([B.units(t, split)])[0].tolist() == tik.encode_ordinary(t)
        assert own.ids([K.split(t)])[0].tolist() == whole.encode(t, add_special_tokens=False).ids


def test_offsets_give_the_tokens_text(tik):
    path = P.path(B.VOCABULARY)
    table, split = B._tokenizer(path), regex.compile(P.PATTERN).findall
    texts = odd_texts()
    ids, sizes = table.ids([B.units(t, split) for t in texts])
    o = B.token_offsets(texts, ids, sizes, path)
    at = 0
    for t, n in zip(texts, sizes):
        for k in range(at, at + n):
            token = tik.decode_single_token_bytes(int(ids[k]))
            assert t.encode()[o["byte_start"][k] : o["byte_end"][k]] == token
            span = t[o["char_start"][k] : o["char_end"][k]]
            assert token in span.encode()
            assert o["cuts"][k] == (token.decode(errors="replace") != span)
        at += n


def test_encode_and_decode_odd_rows(spark, odd_docs, no_docs):
    tokens = B.encode(odd_docs)
    assert [c for c in ("score", "id", "fp") if c in tokens.columns] == ["score", "id", "fp"]
    want = sorted((t or "") for (t,) in odd_docs.select("text").collect())
    assert sorted(B.decode_text(bytes(r.decoded)) for r in B.decode(tokens).collect()) == want
    assert B.decode(B.encode(no_docs)).count() == 0


def test_round_trip_digests_are_those_of_encode_and_decode(odd_docs, no_docs):
    from pyspark.sql import functions as F

    tokens = B.encode(odd_docs).withColumn("ids_sha256", F.sha2("ids", 256))
    want = B.decode(tokens).withColumn("decoded_sha256", F.sha2("decoded", 256))
    cols = ["doc_id", "n_tokens", "n_cut", "ids_sha256", "decoded_sha256", "score", "id"]
    assert sorted(map(str, B.round_trip(odd_docs).select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
    assert B.round_trip(no_docs).count() == 0


def test_word_ids_equal_the_librarys():
    table = K.WordIds(P.path(K.VOCABULARY))
    whole = Tokenizer.from_file(P.path(K.VOCABULARY))
    whole.encode_special_tokens = True
    for t in odd_texts():
        assert table.ids([K.split(t)])[0].tolist() == whole.encode(t, add_special_tokens=False).ids


def test_word_ids_of_a_column_equal_the_librarys():
    import pyarrow as pa

    whole = Tokenizer.from_file(P.path(K.VOCABULARY))
    whole.encode_special_tokens = True
    texts = [None, "  \x0b a\x0c\r\nB \t", "İẞ Ⱥa J̌x it's IT'S it’s ½a1", *odd_texts(), "x" * 3000]
    for limit in (600_000, 0):  # 0: the table starts again with each batch
        table = K.WordIds(P.path(K.VOCABULARY), limit)
        for part in (texts, texts[::-1], [], [None, ""]):
            want = [whole.encode(t or "", add_special_tokens=False).ids for t in part]
            for kind in (pa.string(), pa.large_string()):
                column = pa.array(["left out", *part], kind).slice(1)
                ids, sizes = table.ids(K.split_column(column))
                assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]


def test_a_piece_is_merged_once_whatever_stands_beside_it():
    table = K.WordIds(P.path(K.VOCABULARY))
    merged = []
    merge = table._merge
    table._merge = lambda pieces: merged.extend(pieces) or merge(pieces)
    for text in ("alpha beta", "alpha. (Beta) beta,", "'alpha' beta-alpha ALPHA!", "été Été, «été» alpha"):
        table.ids([K.split(text)])
    assert merged.count("alpha") == merged.count("beta") == merged.count("été") == 1


@pytest.mark.parametrize("sizes", [[1], [4096], [5000, 1, 1, 3], [1] * 300, [4096, 4096, 7], [20_000, 300, 300, 4000]])
def test_assignment_fills_sequences_without_padding(sizes):
    rows = K.assign(np.array(sizes), 4096, 4096.0)
    room = K.capacities(sum(sizes), 4096)
    used = dict.fromkeys(range(len(room)), 0)
    for _, _, n, s, off in rows:
        assert off == used[s] and n > 0
        used[s] += n
    assert [used[s] for s in range(len(room))] == room and sum(room) == sum(sizes)
    assert all(r == 4096 or r & (r - 1) == 0 for r in room)


def test_costs_are_balanced():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 2000, 5000)
    cost = {}
    for _, _, n, s, _ in K.assign(sizes, 4096, 4096.0):
        cost[s] = cost.get(s, 0) + n + n * n / 4096
    full = [cost[s] for s, r in enumerate(K.capacities(int(sizes.sum()), 4096)) if r == 4096]
    assert np.std(full) / np.mean(full) < 0.1


def check_pieces(docs, pieces):
    """Pieces cover each document once and sequences are gapless."""
    whole = Tokenizer.from_file(P.path(K.VOCABULARY))
    whole.encode_special_tokens = True
    left = {}
    for i, t in docs:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        left.setdefault((i, len(ids)), []).append(ids)
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert set(by_doc) == set(left)
    for key, ps in by_doc.items():
        want = sorted((s, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for ids in left[key] for s, n in sorted({(p["start"], p["length"]) for p in ps}))
        if len(left[key]) == 1:
            assert sorted((p["start"], p["ids_crc32"]) for p in ps) == want
            assert sum(p["length"] for p in ps) == key[1]
        else:
            assert sum(p["length"] for p in ps) == key[1] * len(left[key])
    for spans in by_seq.values():
        end = 0
        for off, n in sorted(spans):
            assert off == end
            end += n
        assert end <= 4096 and (end == 4096 or end & (end - 1) == 0)


def test_packing_query_and_odd_rows(spark, odd_docs, no_docs):
    from ratingstream.llm.queries import op10_packing

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    check_pieces(docs, op10_packing(spark, sf).collect())
    odd = K.pack(odd_docs, block_tokens=5000).withColumn("ids_crc32", K.ids_crc32())
    check_pieces(odd_docs.select("doc_id", "text").collect(), odd.collect())
    assert K.pack(no_docs).count() == 0


def test_byte_bpe_query(spark, tik):
    import hashlib

    from ratingstream.llm.queries import op7_byte_bpe

    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = op7_byte_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tik.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
